"""Landing and publication: captures in, contracts out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graylane import storage
from graylane.functions.scalar import civil_date, to_instant
from graylane.operators.windows import bounded
from graylane.sources import marked, versions
from graylane.sources.versions import same_rows


def latest_capture(occurrences: DataFrame, runs: DataFrame, keys: Sequence[str], run: str, stored: str, state: Column) -> DataFrame:
    """Occurrences of the last stored run of each key (scope, entity, day)."""
    last = runs.filter(state).groupBy(*keys).agg(F.max(F.struct(stored, run)).alias("_l")).select(*keys, F.col(f"_l.{run}").alias(run))
    return occurrences.join(last, [*keys, run], "left_semi")


def latest_snapshot(captures: DataFrame, source: str, day: str, per_day: Column, order: Sequence[Column]) -> DataFrame:
    """The last capture of each source, or of each source and day where per_day holds."""
    w = Window.partitionBy(F.col(source), F.when(per_day, F.col(day))).orderBy(*order)
    return captures.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def append_once(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming rows to append: one for each key that the target doesn't have. Nulls count as equal."""
    new = incoming.dropDuplicates(list(keys))
    match = F.lit(True)
    side = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    return new.join(side, match, "left_anti")


def check_capture(df: DataFrame, envelope: str, fields: Sequence[str], key: str, day: str, expected_rows: int | None = None, zone: str | None = None) -> DataFrame:
    """Violations of a capture's contract by code with the number of rows; a capture without a row here is accepted whole.

    NOT_OBJECT, FIELDS (not exactly the declared ones), DUPLICATE_KEY, DAY (the row's day isn't the capture's; with a zone
    its text is an instant or local time, and the day is the zone's), COUNT.
    """
    return _violations(df, [], envelope, fields, key, day, F.lit(expected_rows), zone)


def check_captures(df: DataFrame, run: str, envelope: str, fields: Sequence[str], key: str, day: str, expected: str, zone: str | None = None) -> DataFrame:
    """check_capture for many captures in one pass: run, code, n. expected: the column with the number of rows that a capture states; two numbers in one capture are a COUNT."""
    return _violations(df, [run], envelope, fields, key, day, F.when(F.col("_least") == F.col("_expected"), F.col("_expected")).otherwise(-1), zone, expected)


def _violations(df: DataFrame, by: Sequence[str], envelope: str, fields: Sequence[str], key: str, day: str, rows: Column, zone: str | None, expected: str | None = None) -> DataFrame:
    text = F.get_json_object(envelope, f"$.record.{day}")
    own = F.to_date(text) if zone is None else civil_date(to_instant(text, zone), zone)
    keys = F.json_object_keys(F.get_json_object(envelope, "$.record"))
    stated = F.col(expected) if expected else F.lit(None).cast("long")
    row = df.select(*by, keys.alias("_f"), F.get_json_object(envelope, f"$.record.{key}").alias("_k"), (own != F.col("business_date")).alias("_day"), stated.alias("_stated"))
    declared = F.array_sort(F.array(*[F.lit(f) for f in fields]))
    one = row.groupBy(*by, "_k").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("_f").isNull()).alias("NOT_OBJECT"),
        F.count_if(F.col("_f").isNotNull() & (F.array_sort("_f") != declared)).alias("FIELDS"),
        F.count_if(F.coalesce("_day", F.lit(True))).alias("DAY"),
        F.min("_stated").alias("_least"),
        F.max("_stated").alias("_expected"),
    )
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    repeats = total(F.when(F.col("_k").isNotNull(), F.col("_n") - 1), "DUPLICATE_KEY")
    counts = one.groupBy(*by).agg(*[total(c, c) for c in ("NOT_OBJECT", "FIELDS", "DAY")], repeats, total("_n", "_rows"), F.min("_least").alias("_least"), F.max("_expected").alias("_expected"))
    codes = ["NOT_OBJECT", "FIELDS", "DUPLICATE_KEY", "DAY"]
    off = F.coalesce(F.abs(F.col("_rows") - rows), F.lit(0))
    found = F.array(*[F.struct(F.lit(c).alias("code"), F.col(c).cast("long").alias("n")) for c in codes], F.struct(F.lit("COUNT").alias("code"), off.cast("long").alias("n")))
    return counts.select(*by, F.explode(found).alias("v")).select(*by, "v.*").filter("n > 0")


def land_capture(df: DataFrame, violations: DataFrame, path: str, run: str) -> None:
    """Writes all rows of a capture under its run if it has no violation; else an error and nothing is written. A capture that is landed again stands there once."""
    found = {r.code: r.n for r in violations.collect()}  # at most a row for each code
    if found:
        raise ValueError(f"the capture breaks its contract: {found}")
    df.write.mode("overwrite").parquet(f"{path}/run={run}")


def prepared_or_live(prepared: DataFrame, live: DataFrame, pending: DataFrame) -> DataFrame:
    """The prepared rows, or the live ones while anything is pending; the flag is one row, so only one branch has rows."""
    flag = pending.limit(1).agg((F.count(F.lit(1)) > 0).alias("_stale"))
    a = prepared.join(F.broadcast(flag.filter("not _stale")), how="cross").drop("_stale")
    b = live.join(F.broadcast(flag.filter("_stale")), how="cross").drop("_stale")
    return a.unionByName(b)


def signature(df: DataFrame) -> str:
    """A text that changes with the rows or the columns, not with the order of rows."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}:{df.schema.simpleString()}"


def rebuild_if_changed(inputs: DataFrame, stored: str | None, build: Callable[[], DataFrame], kept: Callable[[], DataFrame]) -> tuple[DataFrame, str, bool]:
    """(table, signature, rebuilt): built anew only where the inputs' signature isn't the stored one."""
    now = signature(inputs)
    return (kept(), now, False) if now == stored else (build(), now, True)


def sync_window(target: DataFrame, source: DataFrame, key: str, date: str, lo: Column, hi: Column) -> DataFrame:
    """key and action for the window lo <= date <= hi of source, matched by key wherever the target's row stands: INSERT, UPDATE (other values, the date among them), KEEP, DELETE (in the window, without a source row); the target's other rows are OUTSIDE."""
    return _sync(target, source, key, date, lo, hi).select(key, "action")


def _sync(target: DataFrame, source: DataFrame, key: str, date: str, lo: Column, hi: Column, also: Sequence[str] = ()) -> DataFrame:
    """key, _t and _s (the other columns of either side), action. also: columns that are carried but not compared."""
    cols = [c for c in target.columns if c != key and c not in also]
    side = lambda df, name: df.select(key, F.struct(*cols).alias(name), *[F.col(c).alias(f"{name}_{c}") for c in also])
    inside = lambda c: F.coalesce((c >= lo) & (c <= hi), F.lit(False))
    j = side(target, "_t").join(side(source.filter(inside(F.col(date))), "_s"), key, "full_outer")
    missing = F.when(inside(F.col(f"_t.{date}")), "DELETE").otherwise("OUTSIDE")
    return j.withColumn("action", F.when(F.col("_t").isNull(), "INSERT").when(F.col("_s").isNull(), missing).when(F.col("_t").eqNullSafe(F.col("_s")), "KEEP").otherwise("UPDATE"))


def sync_keyed(base: str, source: DataFrame, key: str, date: str, part: Column, lo: Column, hi: Column, amount: str, rows: int, total) -> dict[str, int]:
    """Makes the window lo <= date <= hi of the marked table under base what source says, by key, and returns how many rows each action has.

    Source's rows must be the stated number, lie in the window, add up to the stated total and have each a key of its own;
    else it is an error and nothing changes. A row whose date moves into, within or out of the window's partitions is moved:
    the partitions of its old and new date are written again, all in one commit; other partitions aren't touched. part gives
    the partition of a row (the table has one partition column) from its date.
    """
    spark = source.sparkSession
    seen, content = versions.current(spark, base)
    name = content["parts"][0]
    table = marked.read(spark, base)
    columns = [c for c in table.columns if c != name]
    fresh = storage.written(source.select(*columns).withColumn(name, part.cast(table.schema[name].dataType)), "sync-source")
    outside = ~F.coalesce((F.col(date) >= lo) & (F.col(date) <= hi), F.lit(False))
    have = fresh.agg(F.count(F.lit(1)), F.coalesce(F.sum(amount), F.lit(0)), F.count_if(outside | F.col(key).isNull())).first()
    if (have[0], have[1]) != (rows, total) or have[2] or not fresh.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"the window has {have[0]} rows and {have[1]}, stated are {rows} and {total}; {have[2]} rows are outside or have no key")
    found = storage.written(_sync(table, fresh, key, date, lo, hi, [name]).select(key, "action", f"_t_{name}", f"_s_{name}").filter("action != 'OUTSIDE'"), "sync-actions")
    counts = {r.action: r.n for r in found.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most a row for each action
    moved = found.filter("action != 'KEEP'")
    touched = moved.filter("action != 'INSERT'").select(F.col(f"_t_{name}").alias(name)).unionByName(moved.filter("action != 'DELETE'").select(F.col(f"_s_{name}").alias(name))).distinct()
    touched = storage.written(touched, "sync-partitions")
    if not touched.isEmpty():
        stay = table.join(touched, table[name].eqNullSafe(touched[name]), "left_semi").join(moved.select(key), key, "left_anti")
        brought = fresh.join(moved.filter("action != 'DELETE'").select(key), key, "left_semi")
        marked.replace(spark, base, stay.select(*table.columns).unionByName(brought.select(*table.columns)), touched, seen)
    return counts


def missing_days(coverage: DataFrame, day: str, lo: str, hi: str) -> DataFrame:
    """Days from lo to hi that the coverage lacks."""
    spine = coverage.sparkSession.range(1).select(F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).alias(day))
    return spine.join(coverage.select(day).distinct(), day, "left_anti")


def read_contract(table: DataFrame, contract: StructType, where: Column, order: Sequence[Column], limit: int) -> DataFrame:
    """The contract's columns in a stable order; an error if a column is missing or has another type, or if there are more rows."""
    have = {f.name: f.dataType for f in table.schema}
    drift = [f.name for f in contract if have.get(f.name) != f.dataType]
    if drift:
        raise ValueError(f"other than the contract: {', '.join(drift)}")
    return bounded(table.filter(where).select(*contract.names), order, limit)


def import_release(stored: DataFrame, rows: DataFrame, release: str) -> DataFrame:
    """The rows to append: a new release comes whole; one that is stored must be the same rows, and adds none."""
    names = rows.select(release).distinct()
    known = stored.join(names, release, "left_semi")
    again = rows.join(stored.select(release).distinct(), release, "left_semi")
    if not same_rows(known.select(*rows.columns), again):
        raise ValueError("a stored release has other rows")
    return rows.join(stored.select(release).distinct(), release, "left_anti")
