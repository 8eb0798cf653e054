"""Queries by name, each with the DuckDB SQL that must give the same rows (none where SQL can't express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers f(t) under its name; t(table) reads a table of the query's folder."""

    def keep(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__, run.__doc__ = name or f.__name__, f.__doc__
        QUERIES[name or f.__name__] = run
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return keep
