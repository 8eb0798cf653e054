"""Reconciliation: comparisons of data sets, invariants, completeness and eligibility."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graylane.functions.scalar import stable_json_hash


def compare_exports(a: DataFrame, b: DataFrame, cols: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Two exports without a key: rows of measure, left, right, equal.

    rows, tuples (rows of one side alone), one bag of values for each column (values of one side alone) and exact totals.
    """
    sides = a.select(*cols, F.lit(1).alias("_s")).unionByName(b.select(*cols, F.lit(-1).alias("_s")))
    extra = lambda c: F.sum(F.greatest(c, F.lit(0)))
    rows = sides.agg(F.count_if(F.col("_s") == 1).cast("decimal(38,2)").alias("left"), F.count_if(F.col("_s") == -1).cast("decimal(38,2)").alias("right")).select(F.lit("rows").alias("measure"), "left", "right")
    tuples = sides.groupBy(*cols).agg(F.sum("_s").alias("_n")).agg(extra(F.col("_n")).cast("decimal(38,2)").alias("left"), extra(-F.col("_n")).cast("decimal(38,2)").alias("right")).select(F.lit("tuples").alias("measure"), "left", "right")
    names = F.array(*[F.struct(F.lit(f"bag:{c}").alias("measure"), F.col(c).cast("string").alias("value")) for c in cols])
    bags = sides.select("_s", F.explode(names).alias("x")).groupBy("x.measure", "x.value").agg(F.sum("_s").alias("_n"))
    bags = bags.groupBy("measure").agg(extra(F.col("_n")).cast("decimal(38,2)").alias("left"), extra(-F.col("_n")).cast("decimal(38,2)").alias("right"))
    sums = []
    if totals:
        pick = lambda c, s: F.coalesce(F.sum(F.when(F.col("_s") == s, F.col(c).cast("decimal(28,2)"))), F.lit(0)).cast("decimal(38,2)")
        one = sides.agg(*[pick(c, s).alias(f"{c}_{s}") for c in totals for s in (1, -1)])
        sums = [one.select(F.lit(f"total:{c}").alias("measure"), F.col(f"{c}_1").alias("left"), F.col(f"{c}_-1").alias("right")) for c in totals]
    out = functools.reduce(DataFrame.unionByName, [rows, tuples, bags, *sums]).fillna(0)
    equal = F.when(F.col("measure").startswith("bag:") | (F.col("measure") == "tuples"), (F.col("left") == 0) & (F.col("right") == 0)).otherwise(F.col("left") == F.col("right"))
    return out.withColumn("equal", equal)


def bag_digest(df: DataFrame) -> DataFrame:
    """rows, distinct_rows and a digest that don't depend on the order of rows: the sum of the tuples' hashes."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    h = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), F.sha2(F.coalesce(F.sum(h * F.col("_n")), F.lit(0)).cast("string"), 256).alias("digest"))


def row_diff(expected: DataFrame, observed: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """key, column, kind, expected, observed for each difference: MISSING, EXTRA, NULLABILITY or VALUE."""
    e = expected.select(key, *[F.col(c).cast("string").alias(f"e_{c}") for c in cols], F.lit(True).alias("_e"))
    o = observed.select(key, *[F.col(c).cast("string").alias(f"o_{c}") for c in cols], F.lit(True).alias("_o"))
    j = e.join(o, key, "full_outer")
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"e_{c}").alias("expected"), F.col(f"o_{c}").alias("observed")) for c in cols]
    whole = F.array(F.struct(F.lit("*").alias("column"), F.lit(None).cast("string").alias("expected"), F.lit(None).cast("string").alias("observed")))
    alone = F.col("_e").isNull() | F.col("_o").isNull()
    rows = j.select(key, "_e", "_o", F.explode(F.when(alone, whole).otherwise(F.array(*parts))).alias("d")).select(key, "_e", "_o", "d.*")
    kind = F.when(F.col("_o").isNull(), "MISSING").when(F.col("_e").isNull(), "EXTRA").when(F.col("expected").isNull() != F.col("observed").isNull(), "NULLABILITY").when(F.col("expected") != F.col("observed"), "VALUE")
    return rows.withColumn("kind", kind).filter("kind is not null").select(key, "column", "kind", "expected", "observed")


def compare_tables(expected: DataFrame, observed: DataFrame, key: str, sample: int = 3, facts: tuple[dict[str, str], dict[str, str]] = ({}, {}), metadata: Sequence[str] = ()) -> DataFrame:
    """kind, column, n and the sample smallest keys of every kind of difference.

    COLUMN (only one side has it) and TYPE (of another type) tell about the tables, ROW_COUNT by how many rows they
    differ; MISSING, EXTRA, NULLABILITY and VALUE about rows, over the columns that both have in one type. CONTRACT and
    METADATA tell about the facts that are stated of either table (see compare_contracts).
    """
    a, b = dict(expected.dtypes), dict(observed.dtypes)
    key_type = a[key]
    found = [("COLUMN", c) for c in sorted(a.keys() ^ b.keys())] + [("TYPE", c) for c in sorted(a.keys() & b.keys()) if a[c] != b[c]] + compare_contracts(*facts, metadata)
    cols = [c for c in expected.columns if c != key and b.get(c) == a[c]]
    rows = row_diff(expected, observed, key, cols)
    w = Window.partitionBy("kind", "column").orderBy(key)
    firsts = rows.select("kind", "column", key).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= sample).groupBy("kind", "column").agg(F.sort_array(F.collect_list(key)).alias("keys"))
    out = rows.groupBy("kind", "column").agg(F.count(F.lit(1)).alias("n")).join(firsts, ["kind", "column"]).select("kind", "column", "n", "keys")
    none = F.array().cast(f"array<{key_type}>").alias("keys")
    size = expected.agg(F.count(F.lit(1)).alias("_e")).join(observed.agg(F.count(F.lit(1)).alias("_o")), how="cross").filter("_e != _o")
    out = out.unionByName(size.select(F.lit("ROW_COUNT").alias("kind"), F.lit("*").alias("column"), F.abs(F.col("_e") - F.col("_o")).alias("n"), none))
    for kind, c in found:
        out = out.unionByName(expected.sparkSession.range(1).select(F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.lit(1).cast("long").alias("n"), none))
    return out


def view_parity(view: DataFrame, source: DataFrame, key: str, cols: Sequence[str], widths: dict[str, int]) -> DataFrame:
    """key and fault of each published row: UNTRACED (no source row), VALUE (other values), WIDTH (a text is too long)."""
    s = source.select(key, F.struct(*cols).alias("_s"))
    j = view.join(s, key, "left")
    wide = functools.reduce(lambda a, b: a | b, [F.coalesce(F.length(c) > n, F.lit(False)) for c, n in widths.items()], F.lit(False))
    fault = F.when(F.col("_s").isNull(), "UNTRACED").when(~F.struct(*cols).eqNullSafe(F.col("_s")), "VALUE").when(wide, "WIDTH")
    return j.select(key, fault.alias("fault")).filter("fault is not null")


def recomputed(view: DataFrame, source: DataFrame, keys: Sequence[str], totals: dict[str, Column], states: dict[str, Column]) -> DataFrame:
    """keys, column, fault, published and recomputed of what a view states otherwise than its source: totals (aggregates of the source's rows by key) and states (expressions of the recomputed totals); fault is UNTRACED (no source row), MISSING (no published row), TOTAL or STATE. Nulls are values."""
    anew = source.groupBy(*keys).agg(*[v.alias(c) for c, v in totals.items()])
    anew = anew.select(*keys, *totals, *[v.alias(c) for c, v in states.items()])
    cols = [*totals, *states]
    side = lambda df, p: df.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in cols], F.lit(True).alias(f"_{p}"))
    j = side(view, "v").join(side(anew, "s"), list(keys), "full_outer")
    one = lambda c, kind: F.when(~F.col(f"v_{c}").eqNullSafe(F.col(f"s_{c}")), F.struct(F.lit(c).alias("column"), F.lit(kind).alias("fault"), F.col(f"v_{c}").cast("string").alias("published"), F.col(f"s_{c}").cast("string").alias("recomputed")))
    whole = lambda kind: F.array(F.struct(F.lit("*").alias("column"), F.lit(kind).alias("fault"), F.lit(None).cast("string").alias("published"), F.lit(None).cast("string").alias("recomputed")))
    found = F.when(F.col("_s").isNull(), whole("UNTRACED")).when(F.col("_v").isNull(), whole("MISSING")).otherwise(F.array_compact(F.array(*[one(c, "TOTAL") for c in totals], *[one(c, "STATE") for c in states])))
    return j.select(*keys, F.explode(found).alias("f")).select(*keys, "f.*")


def compare_contracts(expected: dict[str, str], observed: dict[str, str], metadata: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(kind, name) of the facts about two tables (version, fingerprint, source) that differ or that one lacks: METADATA for those in metadata, CONTRACT for the others."""
    return [("METADATA" if k in metadata else "CONTRACT", k) for k in sorted(expected.keys() | observed.keys()) if expected.get(k) != observed.get(k)]


def invariants(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule and number of rows that break it, in one pass; null counts as broken."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(k) for k, ok in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("broken")) for k in rules])).alias("r")).select("r.*")


def page_completeness(pages: DataFrame, run: str, page: str, rows: str) -> DataFrame:
    """run, pages, contiguous (from 0, none twice), early_empty (an empty page before the last)."""
    by = pages.groupBy(run).agg(F.count(F.lit(1)).alias("pages"), F.min(page).alias("_lo"), F.max(page).alias("_hi"), F.count_distinct(page).alias("_d"), F.max(F.struct(page, rows)).alias("_last"), F.count_if(F.col(rows) == 0).alias("_empty"))
    last_empty = F.when(F.col(f"_last.{rows}") == 0, 1).otherwise(0)
    return by.select(run, "pages", ((F.col("_lo") == 0) & (F.col("_hi") == F.col("pages") - 1) & (F.col("_d") == F.col("pages"))).alias("contiguous"), (F.col("_empty") - last_empty > 0).alias("early_empty"))


def page_evidence(pages: DataFrame, stated: DataFrame, run: str, page: str, rows: str, terminal: str, first: int = 1) -> DataFrame:
    """stated (run, rows, pages) with what a run's pages prove: fault is the first of NO_PAGES, GAPS (not each page from first on once), PAGES (another number than stated), SUM (other rows than stated), TERMINAL (not just the last page is marked terminal), NOT_EMPTY (it has rows), EARLY_EMPTY, or null; complete if there is none."""
    last = F.max(F.struct(page, F.col(rows).alias("_r"), F.col(terminal).alias("_t")))
    by = pages.groupBy(run).agg(
        F.count(F.lit(1)).alias("_n"), F.min(page).alias("_lo"), F.max(page).alias("_hi"), F.count_distinct(page).alias("_d"), F.coalesce(F.sum(rows), F.lit(0)).alias("_sum"),
        last.alias("_last"), F.count_if(F.col(terminal)).alias("_terminal"), F.count_if(F.coalesce(F.col(rows), F.lit(0)) <= 0).alias("_empty"),
    )
    j = stated.join(by, run, "left")
    gaps = (F.col("_lo") != first) | (F.col("_hi") - F.col("_lo") + 1 != F.col("_n")) | (F.col("_d") != F.col("_n"))
    fault = (
        F.when(F.col("_n").isNull(), "NO_PAGES").when(gaps, "GAPS").when(~F.col("_n").eqNullSafe(F.col("pages")), "PAGES").when(~F.col("_sum").eqNullSafe(F.col("rows")), "SUM")
        .when((F.col("_terminal") != 1) | ~F.coalesce("_last._t", F.lit(False)), "TERMINAL").when(F.coalesce("_last._r", F.lit(0)) != 0, "NOT_EMPTY").when(F.col("_empty") > 1, "EARLY_EMPTY")
    )
    return j.select(*stated.columns, fault.alias("fault"), fault.isNull().alias("complete"))


def repeated_pages(pages: DataFrame, keys: Sequence[str], content: Column, page: str) -> DataFrame:
    """Contents that several pages of one traversal have: keys, h, n, first_page."""
    return pages.groupBy(*keys, F.sha2(content, 256).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min(page).alias("first_page")).filter("n > 1")


def repeated_objects(pages: DataFrame, keys: Sequence[str], json: Column, page: str, drop: Sequence[str] = ()) -> DataFrame:
    """repeated_pages for JSON objects: the order of their fields doesn't count, and neither do the dropped ones."""
    return repeated_pages(pages, keys, stable_json_hash(json, drop), page)


def sweep_eligibility(evidence: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """evidence with reasons (the names of all rules that block, in order) and eligible."""
    reasons = F.filter(F.array(*[F.when(blocks, name) for name, blocks in rules]), lambda r: r.isNotNull())
    return evidence.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def schema_drift(declared: DataFrame, observed: DataFrame, allowed: DataFrame) -> DataFrame:
    """entity, field, change (ADDED, REMOVED) without the allowed ones."""
    j = declared.select("entity", "field", F.lit(1).alias("_d")).distinct().join(observed.select("entity", "field", F.lit(1).alias("_o")).distinct(), ["entity", "field"], "full_outer")
    drift = j.filter("_d is null or _o is null").select("entity", "field", F.when(F.col("_d").isNull(), "ADDED").otherwise("REMOVED").alias("change"))
    return drift.join(allowed, ["entity", "field", "change"], "left_anti")


def compare_keyed(a: DataFrame, b: DataFrame, key: str, date: str, lo: Column, hi: Column, money: str, status: str) -> DataFrame:
    """One row of counts over keys in the half-open window; amounts and states are compared where both sides have one complete row."""

    def side(df, p):
        inside = df.filter((F.col(date) >= lo) & (F.col(date) < hi))
        return inside.groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{p}"), F.min(money).alias(f"_m{p}"), F.min(status).alias(f"_s{p}"))

    j = side(a, "a").join(side(b, "b"), key, "full_outer")
    both = F.col("_na").isNotNull() & F.col("_nb").isNotNull()
    single = both & (F.col("_na") == 1) & (F.col("_nb") == 1)
    full = single & F.col("_ma").isNotNull() & F.col("_mb").isNotNull()
    n = lambda c, name: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    return j.agg(n(F.col("_na").isNull(), "missing_left"), n(F.col("_nb").isNull(), "missing_right"), n((F.col("_na") > 1) | (F.col("_nb") > 1), "duplicates"), n(full & (F.col("_ma") != F.col("_mb")), "money_differs"), n(single & ~F.col("_sa").eqNullSafe(F.col("_sb")), "status_differs"), n(single & (F.col("_ma").isNull() | F.col("_mb").isNull()), "incomplete"))


def compare_traversals(a: DataFrame, b: DataFrame, page: str, key: str) -> DataFrame:
    """page, rows of both traversals, keys that one has alone, keys that stand on another page too (in either traversal), and whether they agree: none of these."""
    both = a.select(page, key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(b.select(page, key, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    per = both.groupBy(page, key).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    spread = per.groupBy(key).agg(F.count(F.lit(1)).alias("_pages")).filter("_pages > 1")
    per = per.join(spread, key, "left")
    by = per.groupBy(page).agg(F.sum("_a").alias("rows_a"), F.sum("_b").alias("rows_b"), F.count_if(F.col("_b") == 0).alias("only_a"), F.count_if(F.col("_a") == 0).alias("only_b"), F.count("_pages").alias("elsewhere"))
    return by.withColumn("agree", (F.col("rows_a") == F.col("rows_b")) & (F.col("only_a") == 0) & (F.col("only_b") == 0) & (F.col("elsewhere") == 0))
