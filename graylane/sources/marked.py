"""Tables whose partitions are replaced by marks.

Rows stand under `<base>/rows/token=<token>/<partition>`, a token for each replacement; the marks of the current version say
which token a partition is read from. A replacement writes its rows, then new marks, and commits them by one rename (see
versions): until then readers see what was, after it what is, and a crash in between leaves rows that no mark names. A
partition may become empty (a mark, no rows) or go (no mark). Only replaced partitions are written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from graylane.sources import versions


def create(spark: SparkSession, base: str, schema: StructType, parts: Sequence[str], stamp: StructType | None = None, **facts) -> None:
    """An empty table. stamp: further columns of the marks, such as the run that a partition has; facts: what its versions carry along."""
    marks = StructType([*[schema[p] for p in parts], *(stamp or [])]).add("token", StringType())
    content = {"schema": schema.json(), "parts": list(parts), "marks": marks.json(), "folder": f"{base}/marks/0"} | facts
    spark.createDataFrame([], marks).write.parquet(content["folder"])
    versions.commit(spark, base, 0, content)


def _content(spark: SparkSession, base: str) -> tuple[int, dict]:
    number, content = versions.current(spark, base)
    if not number:
        raise ValueError(f"there is no table under {base}")
    return number, content


def marks(spark: SparkSession, base: str) -> DataFrame:
    """The marks: the partition's columns, the stamp's, token."""
    return _marks(spark, _content(spark, base)[1])


def _marks(spark: SparkSession, content: dict) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(content["marks"]))).parquet(content["folder"])


def match(a: DataFrame, b: DataFrame, columns: Sequence[str]):
    """a's columns equal b's, nulls too."""
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def read(spark: SparkSession, base: str) -> DataFrame:
    """The table's rows. Spark reads the folders that the marks name, where it can send them to all tasks."""
    return _read(spark, base, _content(spark, base)[1])


def _read(spark: SparkSession, base: str, content: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(content["schema"]))
    if not versions.listed(spark, f"{base}/rows"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema]).add("token", StringType())).parquet(f"{base}/rows")
    named = _marks(spark, content)
    return rows.join(named, match(rows, named, ["token", *content["parts"]]), "left_semi").select(*schema.names)


def replace(spark: SparkSession, base: str, rows: DataFrame, parts: DataFrame, seen: int | None = None, removed: DataFrame | None = None) -> int:
    """Makes rows the content of the partitions in parts (their columns and the stamp's), removes those in removed; returns the new version. versions.Lost if the table is past the version that was seen.

    rows outside of parts are an error of the caller's and are not read. A partition with very many rows is dealt to
    several tasks, small ones share a task.
    """
    number, content = _content(spark, base)
    number = number if seen is None else seen
    token, names = uuid.uuid4().hex, content["parts"]
    schema = StructType.fromJson(json.loads(content["schema"]))
    folder = f"{base}/marks/{token}"
    try:
        rows.select(*schema.names).hint("rebalance", *names).write.mode("append").partitionBy(*names).parquet(f"{base}/rows/token={token}")
        old = _marks(spark, content)
        gone = parts.select(*names) if removed is None else parts.select(*names).unionByName(removed.select(*names))
        new = parts.withColumn("token", F.lit(token)).select(*old.columns)
        old.join(gone, match(old, gone, names), "left_anti").unionByName(new).write.parquet(folder)
        return versions.commit(spark, base, number, content | {"folder": folder})
    except Exception:
        versions.remove(spark, f"{base}/rows/token={token}")
        versions.remove(spark, folder)
        raise


def vacuum(spark: SparkSession, base: str) -> list[str]:
    """Removes the rows of tokens that no mark names, and the marks of earlier versions; to be called while nobody reads or writes an earlier version. Returns the tokens that went."""
    _, content = _content(spark, base)
    # a token for each replacement that still holds a partition
    used = {r.token for r in _marks(spark, content).select("token").distinct().toLocalIterator()}
    gone = [n.removeprefix("token=") for n in versions.listed(spark, f"{base}/rows") if n.startswith("token=") and n.removeprefix("token=") not in used]
    for token in gone:
        versions.remove(spark, f"{base}/rows/token={token}")
    for name in versions.listed(spark, f"{base}/marks"):
        if f"{base}/marks/{name}" != content["folder"]:
            versions.remove(spark, f"{base}/marks/{name}")
    return gone
