"""Facts and intervals: as-of lookups by a merge, ranges by dyadic bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graylane import storage
from graylane.operators.joins import SMALL_ROWS, small

#: Facts of one key beyond which the key is cut by date, one slice for so many.
HOT_ROWS = 1_000_000
#: Numbers of ranges are within 2**-62 and 2**62.
_LEVELS = 62


def overlaps(intervals: DataFrame, on: Sequence[str], lo: str, hi: str) -> DataFrame:
    """on, lo, hi and before (the latest end of the key's earlier intervals) of each interval that begins before an earlier one of its key has ended; of two that begin together the one that ends later counts as the later. Empty intervals (hi <= lo) overlap nothing."""
    w = Window.partitionBy(*on).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    return intervals.filter(F.col(lo) < F.col(hi)).select(*on, lo, hi).withColumn("before", F.max(hi).over(w)).filter(F.col("before") > F.col(lo))


def interval_join(fact: DataFrame, intervals: DataFrame, on: Sequence[str], date: str, lo: str, hi: str) -> DataFrame:
    """fact with the interval lo <= date < hi of its key, null where none holds; each row once. Revoked intervals are to be left out before; intervals of one key that overlap are an error (see overlaps).

    A small table of intervals is sent to all tasks. Else facts and intervals are merged: both are sorted by key and date,
    and the interval that began last is carried along. A key with more than HOT_ROWS facts is cut into slices of its
    dates, and an interval stands in each slice that it reaches into. Null keys and dates have no interval.
    """
    side = storage.written(intervals.filter(F.col(lo) < F.col(hi)).dropna(subset=[*on]), "intervals")
    if not overlaps(side, on, lo, hi).isEmpty():
        raise ValueError("intervals of one key overlap")
    if side.count() <= SMALL_ROWS:
        return _sent(fact, side, on, date, lo, hi)
    return merged(fact, side, on, date, lo, hi)


def _sent(fact: DataFrame, side: DataFrame, on: Sequence[str], date: str, lo: str, hi: str) -> DataFrame:
    own = side.select(*[F.col(k).alias(f"_k_{k}") for k in on], *[c for c in side.columns if c not in on])
    match = (fact[date] >= own[lo]) & (fact[date] < own[hi])
    for k in on:
        match = match & (fact[k] == own[f"_k_{k}"])
    return fact.join(F.broadcast(own), match, "left").drop(*[f"_k_{k}" for k in on])


def _place(c: Column) -> Column:
    return c.cast("timestamp").cast("long")


def merged(fact: DataFrame, side: DataFrame, on: Sequence[str], date: str, lo: str, hi: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """interval_join's merge, for intervals of which no two of one key overlap and none is empty."""
    rest = [c for c in side.columns if c not in on]
    hot = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.min(_place(F.col(date))).alias("_first"), F.max(_place(F.col(date))).alias("_last")).filter(F.col("_n") > hot_rows).dropna(subset=[*on])
    # one row for at least hot_rows facts
    hot = small(storage.written(hot.withColumn("_slices", F.ceil(F.col("_n") / hot_rows).cast("int")).drop("_n"), "hot-keys"))
    cut = lambda c: F.coalesce(F.floor((c - F.col("_first")) * F.col("_slices") / (F.col("_last") - F.col("_first") + 1)).cast("int"), F.lit(0))
    facts = fact.select(F.struct(*fact.columns).alias("_fact"), *on, F.col(date).alias("_at")).join(hot, list(on), "left")
    facts = facts.select("_fact", *on, "_at", F.lit(1).alias("_kind"), F.lit(None).cast(side.select(F.struct(*rest)).schema[0].dataType).alias("_interval"), cut(_place(F.col("_at"))).alias("_slice"))
    spans = side.select(*on, F.col(lo).alias("_at"), F.lit(0).alias("_kind"), F.struct(*rest).alias("_interval"), F.col(hi).alias("_end")).join(hot, list(on), "left")
    inside = F.col("_first").isNull() | ((_place(F.col("_at")) <= F.col("_last")) & (_place(F.col("_end")) >= F.col("_first")))
    reach = F.sequence(F.greatest(F.lit(0), cut(_place(F.col("_at")))), F.least(F.coalesce(F.col("_slices") - 1, F.lit(0)), cut(_place(F.col("_end")))))
    spans = spans.filter(inside).select(F.lit(None).cast(facts.schema["_fact"].dataType).alias("_fact"), *on, "_at", "_kind", "_interval", F.explode(reach).alias("_slice"))
    w = Window.partitionBy(*on, "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = facts.unionByName(spans).withColumn("_open", F.last("_interval", ignorenulls=True).over(w)).filter("_kind = 1")
    holds = F.col("_at") < F.col(f"_open.{hi}")
    return carried.select(*[F.col(f"_fact.{c}").alias(c) for c in fact.columns], *[F.when(holds, F.col(f"_open.{c}")).alias(c) for c in rest])


def dyadic_bins(lo: Column, hi: Column) -> Column:
    """The ranges [bin << level, (bin + 1) << level) that lo .. hi consists of, at most two a level, as an array of (level, bin)."""

    def bins(k: Column) -> Column:
        first, end = -F.call_function("shiftright", -lo, k), F.call_function("shiftright", hi + 1, k)  # halves rounded up and down
        part = lambda n: F.struct(k.alias("level"), n.alias("bin"))
        odd = lambda n: n.bitwiseAND(F.lit(1).cast("long")) == 1
        return F.array_compact(F.array(F.when((first < end) & odd(first), part(first)), F.when((first < end) & odd(end), part(end - 1))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS)), bins))


def ranged_first(fact: DataFrame, rules: DataFrame, number: str, name: str) -> DataFrame:
    """fact with region: a rule of kind RANGE (lo <= number <= hi) before one of kind NAME (label = name); lower priority first.

    A range is a few dyadic bins, two for each power of two at most; each distinct number is looked up once for every power
    that any range has, and fact's rows take the answer by equality; rows that are alike stay as many as they are.
    """
    best = F.min(F.struct("priority", "region"))
    ranges = rules.filter(f"kind = 'RANGE' and lo <= hi and lo > -{1 << _LEVELS} and hi < {1 << _LEVELS}")
    bins = storage.written(ranges.select("lo", "hi", "priority", "region", F.explode(dyadic_bins(F.col("lo").cast("long"), F.col("hi").cast("long"))).alias("_b")).select("priority", "region", F.col("_b.level").alias("_level"), F.col("_b.bin").alias("_bin")), "range-bins")
    levels = [r[0] for r in bins.select("_level").distinct().collect()]  # at most 63
    numbers = fact.select(F.col(number).cast("long").alias("_number")).dropna().distinct()
    numbers = numbers.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumn("_bin", F.call_function("shiftright", F.col("_number"), F.col("_level")))
    ranged = numbers.join(small(bins), ["_level", "_bin"]).groupBy("_number").agg(best["region"].alias("_ranged"))
    named = rules.filter("kind = 'NAME'").groupBy(F.col("label").alias("_name")).agg(best["region"].alias("_named"))
    j = fact.join(small(ranged), F.col(number) == F.col("_number"), "left").join(small(named), F.col(name) == F.col("_name"), "left")
    return j.select(*[fact[c] for c in fact.columns], F.coalesce("_ranged", "_named").alias("region"))
