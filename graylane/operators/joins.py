"""Joins: enrichment, fallbacks, ranges, intervals, relations. Small reference tables go through small(), which checks their size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graylane.operators.windows import latest_per_key

#: Rows up to which a reference table is sent to all executors.
SMALL_ROWS = 200_000


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """df marked for a broadcast if it has at most so many rows; else as it is, for a join by shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def enrich_latest(fact: DataFrame, source: DataFrame, on: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """fact with the first row of source for its key."""
    return fact.join(latest_per_key(source, on, order), list(on), "left")


def lookup_first(fact: DataFrame, reference: DataFrame, pairs: Sequence[tuple[str, str]], value: str, name: str) -> DataFrame:
    """The value of the first of several (fact column, reference key) pairs that is found."""
    out, found = fact, []
    for i, (own, key) in enumerate(pairs):
        side = reference.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k{i}")).agg(F.max(value).alias(f"_v{i}"))
        out = out.join(small(side), F.col(own) == F.col(f"_k{i}"), "left")
        found.append(F.col(f"_v{i}"))
    return out.withColumn(name, F.coalesce(*found)).drop(*[c for i in range(len(pairs)) for c in (f"_k{i}", f"_v{i}")])


def alias_join(fact: DataFrame, entities: DataFrame, own: str, aliases: str, keep: Sequence[str], fold) -> DataFrame:
    """fact joined to the entity one of whose aliases (an array) equals its text after fold; the smallest entity wins a shared alias."""
    rows = entities.select(F.explode(aliases).alias("_a"), *keep).select(fold(F.col("_a")).alias("_a"), *keep)
    rows = rows.groupBy("_a").agg(F.min(F.struct(*keep)).alias("_e")).select("_a", "_e.*")
    return fact.join(small(rows), fold(F.col(own)) == F.col("_a"), "left").drop("_a")


def with_tombstones(live: DataFrame, deleted: DataFrame, key: str, updated: str, deleted_at: str) -> DataFrame:
    """All keys of either side; state DELETED if the deletion is newer than the update or the row is gone, else LIVE."""
    j = live.join(deleted, key, "full_outer")
    gone = F.col(deleted_at).isNotNull() & (F.col(updated).isNull() | (F.col(deleted_at) > F.col(updated)))
    return j.withColumn("state", F.when(gone, "DELETED").otherwise("LIVE"))


def flag_exists(fact: DataFrame, other: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """fact with a flag: other has a row of its key."""
    return fact.join(other.select(*on).distinct().withColumn("_there", F.lit(True)), list(on), "left").withColumn(name, F.coalesce("_there", F.lit(False))).drop("_there")


def unique_lookup(fact: DataFrame, candidates: DataFrame, on: Sequence[str], value: str, name: str) -> DataFrame:
    """fact with the value all candidates of its key agree on, else null."""
    one = candidates.groupBy(*on).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count_if(F.col(value).isNull()).alias("_null"))
    one = one.select(*on, F.when((F.col("_lo") == F.col("_hi")) & (F.col("_null") == 0), F.col("_lo")).alias(name))
    return fact.join(one, list(on), "left")


def null_safe_join(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join that treats nulls as equal; the keys are a's."""
    side = b.select(*[F.col(k).alias(f"_k_{k}") for k in on], *[c for c in b.columns if c not in on])
    match = F.lit(True)
    for k in on:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return a.join(side, match, how).drop(*[f"_k_{k}" for k in on])


def single_fallback(fact: DataFrame, parties: DataFrame, document: str, party: str) -> DataFrame:
    """fact with its party; where it is missing, the document's only party if there is just one."""
    only = parties.groupBy(document).agg(F.min(party).alias("_lo"), F.max(party).alias("_hi"))
    only = only.select(document, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("_only"))
    return fact.join(only, document, "left").withColumn(party, F.coalesce(party, "_only")).drop("_only")


def previous_run(runs: DataFrame, keys: Sequence[str], start: str, state: Column) -> DataFrame:
    """Each run with the start of the closest earlier run of its key in the state."""
    w = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("previous", F.max(F.when(state, F.col(start))).over(w))


def path_union(direct: DataFrame, first: DataFrame, second: DataFrame, value: DataFrame) -> DataFrame:
    """Targets of each root by direct edges (root, target) and through a middle (root, mid) + (mid, target), values summed once a target.

    root, direct_total, via_total, shared_total, total = direct + via - shared.
    """
    via = first.join(second, "mid").select("root", "target").distinct().withColumn("_v", F.lit(1))
    both = direct.select("root", "target").distinct().withColumn("_d", F.lit(1)).join(via, ["root", "target"], "full_outer").join(value, "target")
    part = lambda c, n: F.coalesce(F.sum(F.when(c, F.col("value"))), F.lit(0)).alias(n)
    d, v = F.col("_d").isNotNull(), F.col("_v").isNotNull()
    by = both.groupBy("root").agg(part(d, "direct_total"), part(v, "via_total"), part(d & v, "shared_total"))
    return by.withColumn("total", F.col("direct_total") + F.col("via_total") - F.col("shared_total"))


def current_edges(edges: DataFrame, kind: str, by_pair: Sequence[str], origin: str, target: str, revision: str) -> DataFrame:
    """The edge without a later revision; kinds in by_pair have a current edge for each target, the others one for the origin."""
    key = F.when(F.col(kind).isin(*by_pair), F.col(target))
    return edges.withColumn("_k", key).withColumn("_rn", F.row_number().over(Window.partitionBy(kind, origin, "_k").orderBy(F.desc(revision), F.desc(target)))).filter("_rn = 1").drop("_rn", "_k")


def classify_chain(fact: DataFrame, steps: Sequence[tuple[str, DataFrame, Sequence[str]]], name: str = "class") -> DataFrame:
    """The class of the first table of steps (provenance, table with keys and class, keys) that knows the row."""
    out = fact
    for i, (_, ref, keys) in enumerate(steps):
        side = ref.groupBy(*keys).agg(F.min("class").alias(f"_c{i}"))
        out = out.join(small(side), list(keys), "left")
    found = [F.col(f"_c{i}") for i in range(len(steps))]
    source = F.coalesce(*[F.when(c.isNotNull(), step[0]) for c, step in zip(found, steps, strict=True)], F.lit("none"))
    return out.withColumn(name, F.coalesce(*found)).withColumn(f"{name}_from", source).drop(*[f"_c{i}" for i in range(len(steps))])
