"""Row choice and running values within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order (columns or expressions with a direction)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def top_cohort(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows of each key that tie for the first place."""
    return df.withColumn("_dr", F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order))).filter("_dr = 1").drop("_dr")


def drop_superseded(df: DataFrame, keys: Sequence[str], date: Column, valid: Column) -> DataFrame:
    """Rows not older than the newest valid row of their key; keys without a valid row keep all."""
    newest = F.max(F.when(valid, date)).over(Window.partitionBy(*keys))
    return df.withColumn("_newest", newest).filter(F.col("_newest").isNull() | (date >= F.col("_newest"))).drop("_newest")


def ambiguous_winners(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keys whose first place is shared by several rows: keys, ties."""
    return top_cohort(df, keys, order).groupBy(*keys).agg(F.count(F.lit(1)).alias("ties")).filter("ties > 1")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column) -> DataFrame:
    """df with running (up to the row), total, most, rows and place of each key."""
    w, all_rows = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    return df.withColumns({
        "running": F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "total": F.sum(value).over(all_rows),
        "most": F.max(value).over(all_rows),
        "rows": F.count(F.lit(1)).over(all_rows),
        "place": F.row_number().over(w),
    })


def allocate(df: DataFrame, keys: Sequence[str], total: Column, weight: Column, order: Sequence[Column]) -> DataFrame:
    """df with share: total (the same in all rows of a key) dealt by weight in cents that add up exactly, equally where all weights are 0.

    A share is the difference of two rounded cumulative amounts, so the rounding of one row is made good by the next.
    """
    w = Window.partitionBy(*keys)
    units = "decimal(18,0)"
    df = df.withColumn("_w", (F.coalesce(weight, F.lit(0)).cast("decimal(18,4)") * 10000).cast(units))
    df = df.withColumn("_w", F.when(F.sum("_w").over(w) == 0, F.lit(1).cast(units)).otherwise(F.col("_w")))
    upto = F.sum("_w").over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast(units)
    df = df.withColumn("_upto", upto).withColumn("_sum", F.sum("_w").over(w).cast(units)).withColumn("_cents", F.round(total.cast("decimal(18,2)") * 100).cast("decimal(16,0)"))
    cents = lambda part: f"(sign(_cents) * ((2 * abs(_cents) * {part} + _sum) div (2 * _sum)))"  # noqa: E731  exact, half away from zero
    share = F.expr(f"({cents('_upto')} - {cents('(_upto - _w)')}) / 100").cast("decimal(18,2)")
    return df.withColumn("share", share).drop("_w", "_upto", "_sum", "_cents")


def frontier(parts: DataFrame, keys: Sequence[str], day: str, complete: Column) -> DataFrame:
    """For each key: gaps (days missing between neighbours) and frontier, the last day up to which all days are there and complete."""
    w = Window.partitionBy(*keys).orderBy(day)
    gap = F.datediff(F.col(day), F.lag(day).over(w)) - 1
    marked = parts.withColumn("_gap", F.coalesce(gap, F.lit(0))).withColumn("_bad", F.when(F.col("_gap") > 0, F.date_sub(F.col(day), F.col("_gap").cast("int"))).when(~complete, F.col(day)))
    by = marked.groupBy(*keys).agg(F.sum("_gap").cast("long").alias("gaps"), F.min("_bad").alias("_first"), F.max(day).alias("_last"), F.min(day).alias("_start"))
    reached = F.coalesce(F.date_sub("_first", 1), F.col("_last"))
    return by.select(*keys, "gaps", F.when(reached >= F.col("_start"), reached).alias("frontier"))


def count_over(df: DataFrame, keys: Sequence[str], name: str = "in_group") -> DataFrame:
    """df with the number of rows of each key."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def bounded(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The rows in order (sorted by ranges over all tasks); an error if there are more than n, by a count that every task makes of its own rows."""
    if df.count() > n:
        raise ValueError(f"more than {n} rows")
    return df.orderBy(*order)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence[Column] | None, n: int) -> DataFrame:
    """The next n rows after the position last, descending by the order columns."""
    if last is not None:
        df = df.filter(F.struct(*order) < F.struct(*[c.alias(o) for c, o in zip(last, order, strict=True)]))
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def next_batch(df: DataFrame, eligible: Column, order: Sequence[Column], n: int) -> DataFrame:
    """The n first eligible rows."""
    return df.filter(eligible).orderBy(*order).limit(n)
