"""Group reductions that keep conflicts visible."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graylane.operators.windows import latest_per_key, top_cohort


def consensus(df: DataFrame, keys: Sequence[str], col: str, active: Column | None = None) -> DataFrame:
    """keys, state, value: VALUE when all present values of active rows agree, NULL without any, else CONFLICT."""
    on = F.lit(True) if active is None else active
    value = F.when(on, F.col(col))
    by = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    state = F.when(F.col("_lo").isNull(), "NULL").when(F.col("_lo") == F.col("_hi"), "VALUE").otherwise("CONFLICT")
    return by.select(*keys, state.alias("state"), F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("value"))


def reduce_cohort(df: DataFrame, keys: Sequence[str], order: Sequence[Column], fields: Sequence[str], status: str, precedence: Sequence[str]) -> DataFrame:
    """One row for each key from its freshest rows: each field's state and value (consensus) and the status of first precedence."""
    cohort = top_cohort(df, keys, order)
    ranks = F.create_map(*[F.lit(x) for i, s in enumerate(precedence) for x in (s, i)])
    aggs = [F.count(F.lit(1)).alias("cohort"), F.min(F.coalesce(F.try_element_at(ranks, F.col(status)), F.lit(len(precedence)))).alias("_rank")]
    for f in fields:
        aggs += [F.min(f).alias(f"_lo_{f}"), F.max(f).alias(f"_hi_{f}"), F.count_if(F.col(f).isNull()).alias(f"_null_{f}")]
    by = cohort.groupBy(*keys).agg(*aggs)
    out = [*keys, "cohort", F.element_at(F.array(*[F.lit(s) for s in precedence], F.lit("UNKNOWN")), (F.col("_rank") + 1).cast("int")).alias(status)]
    for f in fields:
        one = (F.col(f"_lo_{f}") == F.col(f"_hi_{f}")) & (F.col(f"_null_{f}") == 0)
        out += [F.when(F.col(f"_lo_{f}").isNull(), "NULL").when(one, "VALUE").otherwise("CONFLICT").alias(f"{f}_state"), F.when(one, F.col(f"_lo_{f}")).alias(f)]
    return by.select(*out)


def reduce_nested(df: DataFrame, keys: Sequence[str], order: Sequence[Column], fields: Sequence[str], metrics: Sequence[str], status: str, precedence: Sequence[str], child: str, attributes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(roots, children) of each key's freshest rows, reduced by child first and then by root, so that a root with very many rows comes as one row for each child.

    roots: keys, cohort (rows), each field's and metric's state and value, status with its state, children, quarantined, and
    conflict: whether any state is CONFLICT. A field with a null beside a value is in conflict; of a metric a null
    complements the one value, and nothing is summed. The status is the first of the precedence; one that it doesn't know
    stands alone or is in conflict. children: keys, child, copies, attributes and disposition; the rows of one child are one
    child, and one whose attributes differ is QUARANTINE without them, else ACCEPTED. A null child is none.
    """
    known = F.col(status).isin(*precedence)
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for i, s in enumerate(precedence) for x in (s, i)]), F.col(status)), F.lit(None).cast("int"))
    named = [*fields, *metrics]
    cohort = top_cohort(df, keys, order).withColumns({"_rank": rank, "_strange": F.when(~known, F.col(status)), "_gap": F.col(status).isNull().cast("int")})
    lows = {f"_lo_{c}": (F.min, c) for c in named} | {f"_lo_{c}": (F.min, c) for c in ("_rank", "_strange")}
    highs = {f"_hi_{c}": (F.max, c) for c in named} | {"_hi__strange": (F.max, "_strange"), "_hi__gap": (F.max, "_gap")}
    nulls = {f"_null_{c}": F.count_if(F.col(c).isNull()) for c in named}
    own = [f(F.col(c)).alias(n) for n, (f, c) in (lows | highs).items()] + [v.alias(n) for n, v in nulls.items()]
    differ = functools.reduce(lambda a, b: a | b, [F.coalesce(F.min(a) != F.max(a), F.lit(False)) | ((F.count_if(F.col(a).isNull()) > 0) & F.max(a).isNotNull()) for a in attributes], F.lit(False))
    by_child = cohort.groupBy(*keys, child).agg(F.count(F.lit(1)).alias("copies"), *own, differ.alias("_differ"), *[F.min(a).alias(f"_attr_{a}") for a in attributes])
    real = F.col(child).isNotNull()
    up = [f(F.col(n)).alias(n) for n, (f, _) in (lows | highs).items()] + [F.sum(n).alias(n) for n in nulls]
    root = by_child.groupBy(*keys).agg(F.sum("copies").alias("cohort"), *up, F.count_if(real & ~F.col("_differ")).alias("children"), F.count_if(real & F.col("_differ")).alias("quarantined"))
    value = {c: F.col(f"_lo_{c}") for c in named}
    one = {c: F.col(f"_lo_{c}").eqNullSafe(F.col(f"_hi_{c}")) & ((F.col(f"_null_{c}") == 0) if c in fields else F.lit(True)) for c in named}
    states = {c: F.when(value[c].isNull(), "NULL").when(one[c], "VALUE").otherwise("CONFLICT") for c in named}
    strange, found, gap = F.col("_lo__strange"), F.col("_lo__rank"), F.col("_hi__gap") == 1
    odd = strange.isNotNull() & ((strange != F.col("_hi__strange")) | found.isNotNull())
    states[status] = F.when(strange.isNull() & found.isNull(), "NULL").when(gap | odd, "CONFLICT").otherwise("VALUE")
    value[status] = F.coalesce(strange, F.get(F.array(*[F.lit(s) for s in precedence]), found))
    out = [x for c in (*named, status) for x in (states[c].alias(f"{c}_state"), F.when(states[c] == "VALUE", value[c]).alias(c))]
    any_conflict = functools.reduce(lambda a, b: a | b, [s == "CONFLICT" for s in states.values()]).alias("conflict")
    state = F.when(F.col("_differ"), "QUARANTINE").otherwise("ACCEPTED")
    kept = [F.when(~F.col("_differ"), F.col(f"_attr_{a}")).alias(a) for a in attributes]
    return root.select(*keys, "cohort", *out, "children", "quarantined", any_conflict), by_child.filter(real).select(*keys, child, "copies", *kept, state.alias("disposition"))


def sticky_any(history: DataFrame, keys: Sequence[str], condition: Column, name: str = "ever") -> DataFrame:
    """True once any row of a key met the condition."""
    return history.groupBy(*keys).agg(F.coalesce(F.bool_or(condition), F.lit(False)).alias(name))


def contributions(parts: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Several kinds of events as counted columns by common keys; one row for each key that any kind has."""
    rows = [df.select(*keys, *[F.lit(1 if k == name else 0).alias(k) for k in parts]) for name, df in parts.items()]
    return functools.reduce(DataFrame.unionByName, rows).groupBy(*keys).agg(*[F.sum(k).alias(k) for k in parts])


def ratio(part: Column, whole: Column, kind: str = "double") -> Column:
    """part / whole, null for a zero denominator."""
    return F.when(whole != 0, part.cast(kind) / whole)


def dimension(df: DataFrame, name: Column, attributes: dict[str, Column]) -> DataFrame:
    """One row for each normalised name, attributes by their greatest value."""
    return df.select(F.upper(F.trim(name)).alias("name"), *[c.alias(k) for k, c in attributes.items()]).filter("name != ''").groupBy("name").agg(*[F.max(k).alias(k) for k in attributes])


def multiset_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: the sum over keys of the smaller number of rows (unchanged), and what is in a or b alone."""
    both = a.groupBy(key).agg(F.count(F.lit(1)).alias("x")).join(b.groupBy(key).agg(F.count(F.lit(1)).alias("y")), key, "full_outer")
    x, y = F.coalesce("x", F.lit(0)), F.coalesce("y", F.lit(0))
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).alias(n)
    return both.agg(total(F.least(x, y), "unchanged"), total(F.greatest(x - y, F.lit(0)), "only_a"), total(F.greatest(y - x, F.lit(0)), "only_b"))


def volume_counts(staged: DataFrame, keys: Sequence[str], identity: str, valid: Column) -> DataFrame:
    """physical = distinct_rows + duplicate + unidentified and distinct_rows = valid + quarantined, by keys; balanced says that both hold."""
    per = staged.groupBy(*keys, identity).agg(F.count(F.lit(1)).alias("_n"), F.bool_and(valid).alias("_ok"))
    known = F.col(identity).isNotNull()
    by = per.groupBy(*keys).agg(
        F.sum("_n").alias("physical"),
        F.count_if(known).alias("distinct_rows"),
        F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("duplicate"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("unidentified"),
        F.count_if(known & F.col("_ok")).alias("valid"),
        F.count_if(known & ~F.coalesce("_ok", F.lit(False))).alias("quarantined"),
    )
    return by.withColumn("balanced", F.expr("physical = distinct_rows + duplicate + unidentified and distinct_rows = valid + quarantined"))


def string_agg_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, sep: str) -> DataFrame:
    """Values joined in the order of the order columns."""
    by = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, value))).alias("_v"))
    return by.select(*keys, F.array_join(F.col(f"_v.{value}"), sep).alias("joined"))


def quality_gate(df: DataFrame, checks: dict[str, tuple[Column, int, int]]) -> DataFrame:
    """A row for each check (failed rows, most rows, most basis points): failed, total, basis_points, result; all in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(bad).alias(f"_{k}") for k, (bad, _, _) in checks.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("check_code"), F.col(f"_{k}").alias("failed"), F.lit(n).alias("most"), F.lit(bp).alias("most_bp")) for k, (_, n, bp) in checks.items()])
    out = counts.select("total", F.explode(rows).alias("c")).select("c.*", "total")
    points = F.when(F.col("total") > 0, F.floor(F.col("failed") * 10000 / F.col("total"))).otherwise(0).cast("long")
    out = out.withColumn("basis_points", points)
    ok = (F.col("failed") <= F.col("most")) & (F.col("basis_points") <= F.col("most_bp"))
    return out.select("check_code", "failed", "total", "basis_points", F.when(ok, "PASS").otherwise("FAIL").alias("result"))


def gated(results: DataFrame) -> DataFrame:
    """The results of quality_gate and a row GATE: failed is the number of checks that fail, total that of all; it passes if there are checks and none fails."""
    whole = results.agg(F.count_if(F.col("result") != "PASS").alias("failed"), F.count(F.lit(1)).alias("total"))
    gate = whole.select(F.lit("GATE").alias("check_code"), "failed", "total", F.when(F.col("total") > 0, F.floor(F.col("failed") * 10000 / F.col("total"))).otherwise(0).cast("long").alias("basis_points"), F.when((F.col("failed") == 0) & (F.col("total") > 0), "PASS").otherwise("FAIL").alias("result"))
    return results.unionByName(gate)


def overall_state(df: DataFrame, keys: Sequence[str], state: str, precedence: Sequence[str]) -> DataFrame:
    """Counts of each state and the first state of the precedence that occurs."""
    by = df.groupBy(*keys).agg(*[F.count_if(F.col(state) == s).alias(s.lower()) for s in precedence])
    return by.withColumn("overall", F.coalesce(*[F.when(F.col(s.lower()) > 0, s) for s in precedence], F.lit("NONE")))


def overview(df: DataFrame, keys: Sequence[str], distinct: dict[str, Column], sums: dict[str, Column], at: str, complete: tuple[str, int]) -> DataFrame:
    """keys: rows (n), distinct counts, sums, first and last time; COMPLETE if the named distinct count is at least so much, else PARTIAL."""
    counts = [F.count_distinct(c).alias(n) for n, c in distinct.items()]
    by = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *counts, *[F.sum(c).alias(n) for n, c in sums.items()], F.min(at).alias("first_ts"), F.max(at).alias("last_ts"))
    return by.withColumn("status", F.when(F.col(complete[0]) >= complete[1], "COMPLETE").otherwise("PARTIAL"))


def counts_where(df: DataFrame, keys: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """keys: for each condition the number of rows for which it holds."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def run_monitor(runs: DataFrame, logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """runs (keys, started, ended) with seconds, and of their logs (keys, failed, rows) entries, rows, errors and an error class.

    HIGH: over a quarter of the entries failed; SOME; NONE; SILENT: no log at all.
    """
    by = logs.groupBy(*keys).agg(F.count(F.lit(1)).alias("entries"), F.sum("rows").alias("rows"), F.count_if(F.col("failed")).alias("errors"))
    j = runs.join(by, list(keys), "left")
    bad = F.when(F.col("entries").isNull(), "SILENT").when(F.col("errors") * 4 > F.col("entries"), "HIGH").when(F.col("errors") > 0, "SOME").otherwise("NONE")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("entries", "rows", "errors")]
    return j.select(*keys, (F.unix_timestamp("ended") - F.unix_timestamp("started")).alias("seconds"), *zero, bad.alias("error_class"))


def run_health(attempts: DataFrame, run: str, page: str, order: Sequence[Column], failed: Column, amount: Column, pages: int, size: Column | None = None, gates: DataFrame | None = None) -> DataFrame:
    """The latest attempt of each page, then run: pages, total, failed, and a state: FAILED, PARTIAL (fewer pages than stated), GATED (the run's gate in gates (run, passed) doesn't pass or isn't there) or OK. size: bytes of a page, summed as bytes."""
    p = latest_per_key(attempts, [run, page], order)
    sums = [F.sum(size).alias("bytes")] if size is not None else []
    by = p.groupBy(run).agg(F.count(F.lit(1)).alias("pages"), F.sum(amount).alias("total"), F.count_if(failed).alias("failed"), *sums)
    passed = F.lit(True)
    if gates is not None:
        by, passed = by.join(gates.groupBy(run).agg(F.bool_and("passed").alias("_passed")), run, "left"), F.coalesce("_passed", F.lit(False))
    return by.withColumn("state", F.when(F.col("failed") > 0, "FAILED").when(F.col("pages") < pages, "PARTIAL").when(~passed, "GATED").otherwise("OK")).drop("_passed")
