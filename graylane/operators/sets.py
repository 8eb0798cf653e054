"""Set and multiset comparisons."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*parts: DataFrame, distinct: bool = False) -> DataFrame:
    out = functools.reduce(DataFrame.unionByName, parts)
    return out.distinct() if distinct else out


def equal_columns(pairs: Sequence[tuple[str, str]]) -> Column:
    """All pairs of columns are equal, nulls counting as equal."""
    return functools.reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


def multiset_diff(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that one side has more often: cols, side (a or b), n. One grouping of both sides together."""
    both = a.select(*cols, F.lit(1).alias("_n")).unionByName(b.select(*cols, F.lit(-1).alias("_n")))
    by = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n != 0")
    return by.select(*cols, F.when(F.col("_n") > 0, "a").otherwise("b").alias("side"), F.abs("_n").alias("n"))


def same_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: only_a, only_b (distinct rows that the other side lacks) and same."""
    both = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(b.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    by = both.groupBy(*a.columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    out = by.agg(F.count_if(F.col("_b") == 0).alias("only_a"), F.count_if(F.col("_a") == 0).alias("only_b"))
    return out.withColumn("same", (F.col("only_a") == 0) & (F.col("only_b") == 0))
