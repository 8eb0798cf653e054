"""Versions of a set of tables, switched by one rename.

A publication writes its tables into a folder of its own, then a small commit file, and moves that to
`<base>/_commits/<number>`. The move fails where the number is taken, so of several publishers that started from one version
one wins; the others remove what they wrote. Readers take the highest commit, whole as it was moved there, and never meet
half a publication. The file system must rename atomically and refuse an existing target (HDFS and local ones do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from graylane import storage
from graylane.operators.sets import multiset_diff


class Lost(RuntimeError):
    """Another publication came first, or what this one rests on moved."""


def _files(spark: SparkSession, base: str):
    """(file context, Path class) of base's file system."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(base).toUri(), spark._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def current(spark: SparkSession, base: str) -> tuple[int, dict]:
    """(number, content) of the last commit; (0, {}) if there is none."""
    numbers = [int(n) for n in listed(spark, f"{base}/_commits") if n.isdigit()]
    if not numbers:
        return 0, {}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/_commits/{max(numbers)}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return max(numbers), json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, base: str, seen: int, content: dict) -> int:
    """Makes content the version after the one that was seen; Lost if there is one already."""
    files, path = _files(spark, base)
    new, target = path(f"{base}/_new-{uuid.uuid4().hex}"), path(f"{base}/_commits/{seen + 1}")
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    stream = fs.create(new, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        files.rename(new, target, how)
    except Exception as error:
        fs.delete(new, False)
        if "FileAlreadyExistsException" in str(error):
            raise Lost(f"version {seen + 1} of {base} was published by another") from error
        raise
    return seen + 1


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Both have the same rows as often."""
    return multiset_diff(a, b, a.columns).isEmpty()


def publish(spark: SparkSession, base: str, outputs: dict[str, DataFrame], fence: Callable[[], DataFrame] | None = None, keep: int = 2) -> int:
    """Publishes all outputs as the next version and returns its number; Lost, and nothing left behind, if the fence's rows moved meanwhile or another version came first.

    The last `keep` versions stay for readers that have them open; older ones are removed.
    """
    seen, _ = current(spark, base)
    folder = f"{base}/versions/{uuid.uuid4().hex}"
    try:
        before = storage.written(fence(), "fence") if fence else None
        for name, df in outputs.items():
            df.write.parquet(f"{folder}/{name}")
        if before is not None and not same_rows(before, fence()):
            raise Lost("the coverage moved during the publication")
        number = commit(spark, base, seen, {"folder": folder, "tables": {name: df.schema.json() for name, df in outputs.items()}})
    except Exception:
        remove(spark, folder)
        raise
    prune(spark, base, keep)
    return number


def prune(spark: SparkSession, base: str, keep: int) -> None:
    """Removes the commits below the last `keep` and the folders that no commit names. A publication that has not yet committed is left alone: its folder is younger than the last commit."""
    numbers = sorted(int(n) for n in listed(spark, f"{base}/_commits") if n.isdigit())
    for n in numbers[:-keep]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/_commits/{n}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        stream = fs.open(path)
        folder = json.loads(bytes(stream.readAllBytes()).decode()).get("folder")
        stream.close()
        if folder:
            remove(spark, folder)
        fs.delete(path, False)


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the current version."""
    number, content = current(spark, base)
    if not number:
        raise ValueError(f"nothing is published under {base}")
    return spark.read.schema(StructType.fromJson(json.loads(content["tables"][name]))).parquet(f"{content['folder']}/{name}")
