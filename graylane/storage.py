"""Written tables in the folder that all executors share (spark.checkpoint.dir; set here only where it is unset, as in tests)."""

from __future__ import annotations

import os
import tempfile
import uuid

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes an execution's shuffle files when it ends, not when the driver happens to collect its garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{os.path.join(tempfile.gettempdir(), 'graylane-checkpoints')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """df written as a table in the shared folder and read again: the lineage ends there, on storage that outlives executors. free: as settled()."""
    path = new_path(df.sparkSession, label)
    if free:
        settled(df, path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, path: str) -> str:
    """df written to a path under shared_dir; the shuffle files of the write go as soon as it is done (another action on df makes its own)."""
    conf = df.sparkSession.conf
    before = conf.get(_FREE, None)
    conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_FREE) if before is None else conf.set(_FREE, before)
    return path


def read(spark: SparkSession, df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """What settled() wrote, with the schema of df."""
    return spark.read.schema(df.schema).parquet(*paths)


def removed(spark: SparkSession, paths: Iterable[str]) -> None:
    """Takes tables away that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
