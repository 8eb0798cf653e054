"""Change capture, history and incremental recomputation over batch tables."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from graylane import storage
from graylane.functions.scalar import framed_hash
from graylane.operators.joins import small
from graylane.operators.windows import ambiguous_winners, latest_per_key
from graylane.sources import marked, versions


def decide(current: DataFrame, incoming: DataFrame, key: str, freshness: str, content: str) -> DataFrame:
    """A decision for each key of both tables: key, old and new freshness and content, decision.

    INSERT, UPDATE, STALE (older), REPLAY (same content at the same freshness), CONFLICT (other content at the same
    freshness), NULL_FRESHNESS (no freshness on one side and other content), KEEP (not incoming).
    """
    side = lambda df, p: df.select(key, F.col(freshness).alias(f"{p}_{freshness}"), F.col(content).alias(f"{p}_{content}"), F.lit(True).alias(f"_{p}"))
    j = side(current, "old").join(side(incoming, "new"), key, "full_outer")
    old, new = F.col(f"old_{freshness}"), F.col(f"new_{freshness}")
    same = F.col(f"old_{content}").eqNullSafe(F.col(f"new_{content}"))
    decision = (
        F.when(F.col("_new").isNull(), "KEEP").when(F.col("_old").isNull(), "INSERT").when(old.eqNullSafe(new) & same, "REPLAY")
        .when(old.isNull() | new.isNull(), "NULL_FRESHNESS").when(new < old, "STALE").when(new == old, "CONFLICT").otherwise("UPDATE")
    )
    return j.withColumn("decision", decision).drop("_old", "_new")


def apply_changes(current: DataFrame, incoming: DataFrame, key: str, freshness: str, content: str) -> DataFrame:
    """The table after the accepted rows (INSERT, UPDATE), with each row's decision."""
    d = decide(current, incoming, key, freshness, content)
    new = F.col("decision").isin("INSERT", "UPDATE")
    pick = lambda c: F.when(new, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c)
    return d.select(key, pick(freshness), pick(content), "decision")


def receipt(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


def patch(current: DataFrame, incoming: DataFrame, key: str, freshness: str, fields: Sequence[str]) -> DataFrame:
    """Field by field: ABSENT keeps the old value, NULL clears it, VALUE replaces it; a stale row changes nothing.

    incoming has <field>_presence beside each field.
    """
    n = incoming.select(key, F.col(freshness).alias("_f"), *[F.col(f).alias(f"_{f}") for f in fields], *[F.col(f"{f}_presence").alias(f"_{f}_p") for f in fields])
    j = current.join(n, key, "left")
    fresh = F.col("_f").isNotNull() & (F.col(freshness).isNull() | (F.col("_f") > F.col(freshness)))
    out = [F.when(fresh & (F.col(f"_{f}_p") == "VALUE"), F.col(f"_{f}")).when(fresh & (F.col(f"_{f}_p") == "NULL"), F.lit(None)).otherwise(F.col(f)).alias(f) for f in fields]
    return j.select(key, F.when(fresh, F.col("_f")).otherwise(F.col(freshness)).alias(freshness), *out, fresh.alias("applied"))


def screen_batch(df: DataFrame, keys: Sequence[str], freshness: str, content: str, ordinal: str, root: Sequence[str] = (), units: Sequence[str] = (), stored: DataFrame | None = None) -> DataFrame:
    """df with disposition inside the batch: STALE (not the freshest), QUARANTINE (several contents at the freshest), DUPLICATE (not the first copy), QUARANTINE_UNIT, else ACCEPT.

    QUARANTINE_UNIT is an acceptable row whose root has rows of several values of a unit (currency, measure) in the batch,
    stale and repeated ones counting too, or another one in stored (root and units). Nulls tell nothing.
    """
    w = Window.partitionBy(*keys)
    top = F.max(freshness).over(w)
    df = df.withColumn("_top", F.col(freshness).eqNullSafe(top))
    best = Window.partitionBy(*keys, "_top")
    mixed = F.min(content).over(best) != F.max(content).over(best)
    state = F.when(~F.col("_top"), "STALE").when(mixed, "QUARANTINE").when(F.col(ordinal) != F.min(ordinal).over(best), "DUPLICATE").otherwise("ACCEPT")
    out = df.withColumn("disposition", state).drop("_top")
    if not units:
        return out
    differ = lambda x, y: functools.reduce(operator.or_, [F.coalesce(F.col(a) != b, F.lit(False)) for a, b in zip(x, y, strict=True)])
    several = df.groupBy(*root).agg(*[F.min(u).alias(f"_lo_{u}") for u in units], *[F.max(u).alias(f"_hi_{u}") for u in units])
    several = several.select(*root, differ([f"_lo_{u}" for u in units], [F.col(f"_hi_{u}") for u in units]).alias("_several"))
    out, off = out.join(several, list(root), "left"), F.coalesce("_several", F.lit(False))
    if stored is not None:
        out = out.join(stored.select(*root, *[F.col(u).alias(f"_own_{u}") for u in units]), list(root), "left")
        off = off | differ(units, [F.col(f"_own_{u}") for u in units])
    return out.withColumn("disposition", F.when((F.col("disposition") == "ACCEPT") & off, "QUARANTINE_UNIT").otherwise(F.col("disposition"))).select(*df.drop("_top").columns, "disposition")


def reactivation(versions: DataFrame, keys: Sequence[str], revision: str, active: Column, flagged: Column) -> DataFrame:
    """Each version with its effect: an inactive key becomes active only by a flagged version of a greater revision."""
    w = Window.partitionBy(*keys).orderBy(revision)
    before = F.lag(active).over(w)
    state = F.when(before.isNull(), "FIRST").when(~before & active & flagged, "REACTIVATED").when(~before & active, "REFUSED").when(before & ~active, "DEACTIVATED").otherwise("UNCHANGED")
    return versions.withColumn("effect", state)


def history(decisions: DataFrame, key: str, content: str) -> DataFrame:
    """A row for each accepted change: key, action, old and new value."""
    return decisions.filter(F.col("decision").isin("INSERT", "UPDATE")).select(key, F.col("decision").alias("action"), F.col(f"old_{content}").alias("old_value"), F.col(f"new_{content}").alias("new_value"))


def lineage(lines: DataFrame, target: str, source: str) -> DataFrame:
    """The distinct source ids behind each target."""
    return lines.select(target, source).distinct()


def current_view(df: DataFrame, keys: Sequence[str], order: Sequence[Column], active: Column, quarantined: DataFrame, at: str) -> DataFrame:
    """The latest row of each key if it is active and no quarantined row is newer."""
    latest = latest_per_key(df, keys, order).filter(active)
    newest = quarantined.groupBy(*keys).agg(F.max(at).alias("_q"))
    return latest.join(newest, list(keys), "left").filter(F.col("_q").isNull() | (F.col("_q") <= F.col(at))).drop("_q")


def refresh_winners(state: DataFrame, rows: DataFrame, touched: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """state with the winners of the touched keys recomputed from rows; touched keys without rows go inactive."""
    touched = touched.select(*keys).distinct()
    fresh = latest_per_key(rows.join(touched, list(keys), "left_semi"), keys, order).select(*[c for c in state.columns if c != "active"]).withColumn("active", F.lit(True))
    gone = state.join(touched, list(keys), "left_semi").join(fresh, list(keys), "left_anti").withColumn("active", F.lit(False))
    return state.join(touched, list(keys), "left_anti").unionByName(fresh).unionByName(gone)


def incremental_detail(inputs: DataFrame, state: DataFrame, key: str, signature: str) -> DataFrame:
    """Keys to recompute: signature of the inputs other than the stored one, new or gone: key, change."""
    a, b = inputs.select(key, F.col(signature).alias("_new")), state.select(key, F.col(signature).alias("_old"))
    j = a.join(b, key, "full_outer").filter(~F.col("_new").eqNullSafe(F.col("_old")))
    return j.select(key, F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "GONE").otherwise("CHANGED").alias("change"))


def refresh_detail(base: str, inputs: DataFrame, key: str, shared: str, order: Sequence[Column], compute) -> dict[str, int]:
    """Brings the published detail under base to what compute(inputs) gives; only the keys that need it are computed, only buckets with changed rows written.

    <base>/rows has what compute gives and bucket (create_detail makes both tables); <base>/state has key, shared, in_sig
    (of the inputs that a row was computed from) and out_sig (of the row). Inputs, state and published rows are joined in
    full by key: changed is a key that one of them lacks, or whose inputs or published row aren't as the state says (a
    signature that is missing counts as another one). Affected are these and all inputs that share a secondary key with
    them, as it is now, as it was and as it is published, null being a secondary key too. Of what is computed for them only
    rows other than the published ones are written. The rows are committed before the state, so after a crash in between the
    next run finds the same keys changed. Where a key stands twice in the published rows or is missing there, or its input
    rows can't be told apart by the order, all is computed. Returns how many keys were changed, affected and written.
    """
    spark = inputs.sparkSession
    rows, state = (marked.read(spark, f"{base}/{t}") for t in ("rows", "state"))
    seen, seen_state = (versions.current(spark, f"{base}/{t}")[0] for t in ("rows", "state"))
    cols = [c for c in rows.columns if c != "bucket"]
    buckets = _buckets(spark, base)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    twice = not rows.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).isEmpty()
    whole = twice or not ambiguous_winners(inputs, [key], order).isEmpty()
    out = rows.select(key, F.col(shared).alias("_pub"), framed_hash(cols).alias("_out"), F.col("bucket").alias("_b"))
    if whole:
        affected = storage.written(inputs.select(key).unionByName(rows.select(key)).unionByName(state.select(key)).distinct(), "affected-keys")
        changed = affected
    else:
        new = inputs.select(key, F.col(shared).alias("_now"), framed_hash(inputs.columns).alias("_in"), F.lit(True).alias("_i"))
        kept = state.select(key, F.col(shared).alias("_was"), F.col("in_sig").alias("_sin"), F.col("out_sig").alias("_sout"), F.lit(True).alias("_s"))
        j = new.join(kept, key, "full_outer").join(out.withColumn("_p", F.lit(True)), key, "full_outer")
        right = F.col("_i").isNotNull() & F.col("_s").isNotNull() & F.col("_in").eqNullSafe(F.col("_sin")) & F.col("_out").eqNullSafe(F.col("_sout"))
        changed = storage.written(j.filter(~right).select(key, "_now", "_was", "_pub", "_i", "_s", "_p"), "changed-keys")
        groups = changed.select(F.explode(F.array(*[F.struct(F.col(v).alias("_g"), F.col(f).isNotNull().alias("_f")) for v, f in (("_now", "_i"), ("_was", "_s"), ("_pub", "_p"))])).alias("x")).filter("x._f").select("x._g").distinct()
        affected = storage.written(inputs.join(groups, inputs[shared].eqNullSafe(groups["_g"]), "left_semi").select(key).unionByName(changed.select(key)).distinct(), "affected-keys")
    anew = storage.written(compute(inputs.join(affected, key, "left_semi")).select(*cols).withColumn("_new", framed_hash(cols)), "computed-rows")
    held = affected.join(out.select(key, "_out", "_b").distinct(), key, "left").join(anew.select(key, "_new"), key, "left")
    write = storage.written(held.filter(~F.col("_out").eqNullSafe(F.col("_new")) if not twice else F.lit(True)).select(key, bucket, "_b").distinct(), "written-keys")
    n = write.select(key).distinct().count()
    if n or twice:
        touched = write.select("bucket").unionByName(write.filter("_b is not null").select(F.col("_b").alias("bucket"))).distinct() if not twice else spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        stay = rows.join(small(touched), "bucket", "left_semi").join(write, key, "left_anti").filter(F.lit(not twice))
        content = stay.select(*cols).unionByName(anew.join(write, key, "left_semi").select(*cols)).withColumn("bucket", bucket)
        marked.replace(spark, f"{base}/rows", content, touched, seen)
    signed = inputs.join(affected, key, "left_semi").select(key, shared, framed_hash(inputs.columns).alias("in_sig")).dropDuplicates([key]).join(anew.select(key, F.col("_new").alias("out_sig")), key, "left")
    touched = storage.written(affected.select(bucket).distinct(), "state-buckets")
    if not touched.isEmpty():
        stay = state.join(small(touched), "bucket", "left_semi").join(affected, key, "left_anti")
        marked.replace(spark, f"{base}/state", stay.select(key, shared, "in_sig", "out_sig").unionByName(signed).withColumn("bucket", bucket), touched, seen_state)
    return {"changed": changed.count(), "affected": affected.count(), "written": n}


def create_detail(spark: SparkSession, base: str, schema: StructType, key: str, shared: str, buckets: int = 64) -> None:
    """The empty tables of refresh_detail: schema is that of compute's rows."""
    state = StructType([schema[key], schema[shared], StructField("in_sig", StringType()), StructField("out_sig", StringType())])
    for name, kind in (("rows", schema), ("state", state)):
        marked.create(spark, f"{base}/{name}", StructType([*kind, StructField("bucket", IntegerType())]), ["bucket"], buckets=buckets)


def _buckets(spark: SparkSession, base: str) -> int:
    return versions.current(spark, f"{base}/rows")[1]["buckets"]


def pending_partitions(coverage: DataFrame, applied: DataFrame, keys: Sequence[str], run: str) -> DataFrame:
    """Partitions whose covered run isn't the applied one: keys, the run to apply (null: to remove)."""
    j = coverage.select(*keys, F.col(run).alias("_c")).join(applied.select(*keys, F.col(run).alias("_a")), list(keys), "full_outer")
    return j.filter(~F.col("_c").eqNullSafe(F.col("_a"))).select(*keys, F.col("_c").alias(run))


def replace_partitions(base: str, fresh: DataFrame, coverage: DataFrame, run: str, expected: DataFrame) -> DataFrame:
    """Takes the partitions of the marked table under base whose covered run isn't the applied one from fresh, and returns them with the run that they have now.

    coverage: the partition's columns and run. The applied runs are the table's marks, so rows and marks change in one
    commit. expected: the partition's columns and rows, what each run states, no row meaning 0; another count in a pending
    partition is an error and nothing changes. A run without rows leaves an empty partition under its mark; a partition
    that isn't covered any more is removed.
    """
    spark, parts = fresh.sparkSession, versions.current(fresh.sparkSession, base)[1]["parts"]
    seen = versions.current(spark, base)[0]
    pending = storage.written(pending_partitions(coverage, marked.marks(spark, base).select(*parts, run), parts, run), "pending-partitions")
    if pending.isEmpty():
        return pending
    due = pending.filter(F.col(run).isNotNull())
    own = [*parts, run] if run in fresh.columns else parts
    new = storage.written(fresh.join(small(due.select(*own)), own, "left_semi"), "fresh-partitions")
    have = new.groupBy(*parts).agg(F.count(F.lit(1)).alias("_have"))
    stated = expected.select(*parts, F.col("rows").alias("_stated"))
    off = due.join(have, parts, "left").join(stated, parts, "left").filter(F.coalesce("_have", F.lit(0)) != F.coalesce("_stated", F.lit(0)))
    if not off.isEmpty():
        raise ValueError("a partition has other rows than its run states")
    marked.replace(spark, base, new, due.select(*parts, run), seen, pending.filter(F.col(run).isNull()))
    return pending


def materialize_receipt(decisions: DataFrame, stored: DataFrame, name: str) -> DataFrame:
    """One row: inserts, updates, noops, blocked, candidates, and status NEW, REPLAY (the stored receipt has these counts) or MISMATCH."""
    n = lambda *d: F.count_if(F.col("decision").isin(*d))
    counts = decisions.agg(n("INSERT").alias("inserts"), n("UPDATE").alias("updates"), n("REPLAY", "KEEP").alias("noops"), n("STALE", "CONFLICT", "NULL_FRESHNESS").alias("blocked"), F.count(F.lit(1)).alias("candidates"))
    s = stored.filter(F.col("receipt") == name).select(F.struct("inserts", "updates", "noops", "blocked").alias("_s"))
    own = F.struct("inserts", "updates", "noops", "blocked")
    return counts.join(s, F.lit(True), "left").withColumn("status", F.when(F.col("_s").isNull(), "NEW").when(F.col("_s") == own, "REPLAY").otherwise("MISMATCH")).drop("_s")


def accepted_receipt(decisions: DataFrame, stored: DataFrame, name: str) -> DataFrame:
    """materialize_receipt, with an error where the stored receipt has other counts."""
    one = materialize_receipt(decisions, stored, name)
    if not one.filter("status = 'MISMATCH'").isEmpty():
        raise ValueError(f"receipt {name} was given for other inputs")
    return one


def absence_sweep(current: DataFrame, seen: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """key, confirmations, status after one complete sweep: PRESENT, SUSPECT (absent once), EXCLUDED (twice), REACTIVATED."""
    j = current.select(key).join(seen.select(key, F.lit(True).alias("_s")).distinct(), key, "left").join(state.select(key, F.col("confirmations").alias("_n")), key, "left")
    before, there = F.coalesce("_n", F.lit(0)), F.col("_s").isNotNull()
    n = F.when(there, 0).otherwise(F.least(before + 1, F.lit(2)))
    status = F.when(there & (before >= 2), "REACTIVATED").when(there, "PRESENT").when(before >= 1, "EXCLUDED").otherwise("SUSPECT")
    return j.select(key, n.cast("int").alias("confirmations"), status.alias("status"))


def counted_sweeps(sweeps: DataFrame) -> DataFrame:
    """The sweeps that count, numbered from 1: sweep, n. sweeps: sweep, at, capture, scope, complete, eligible.

    A sweep counts if it is complete (see page_evidence) and eligible (see sweep_eligibility), its capture was used by no
    earlier sweep, and its scope is that of the first one that counts; a null says no.
    """
    good = sweeps.filter(F.coalesce("complete", F.lit(False)) & F.coalesce("eligible", F.lit(False)) & F.col("capture").isNotNull())
    used = sweeps.groupBy("capture").agg(F.min(F.struct("at", "sweep")).alias("_first"))
    good = good.join(used, "capture").filter(F.struct("at", "sweep") == F.col("_first"))
    scope = good.agg(F.min_by("scope", F.struct("at", "sweep")).alias("_scope"))
    # a row for each sweep
    return good.join(F.broadcast(scope), F.col("scope").eqNullSafe(F.col("_scope"))).select("sweep", F.row_number().over(Window.orderBy("at", "sweep")).alias("n"))


def absence_history(current: DataFrame, seen: DataFrame, sweeps: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(history, state) of the current keys over the sweeps that count (counted_sweeps); seen: sweep, key.

    A key that a sweep misses is SUSPECT, after the next one too EXCLUDED; seen again it is REACTIVATED. history has a row
    for each such change: key, sweep, before, after (confirmations, 0 to 2), status. state: key, confirmations, and
    first_absent, the sweep that missed it first of those since it was last seen. Gaps between the sweeps that saw a key
    give its changes, so the work grows with what was seen, not with keys times sweeps.
    """
    valid = storage.written(counted_sweeps(sweeps), "counted-sweeps")
    last = valid.agg(F.coalesce(F.max("n"), F.lit(0)).alias("_last"))
    met = seen.join(small(valid), "sweep").select(key, "n").distinct().join(current.select(key).distinct(), key, "left_semi")
    marks = met.unionByName(current.select(key).distinct().withColumn("n", F.lit(0))).join(F.broadcast(last))
    w = Window.partitionBy(key).orderBy("n")
    gaps = marks.select(key, "n", F.lead("n").over(w).alias("_next"), "_last").withColumn("_gap", F.coalesce("_next", F.col("_last") + 1) - F.col("n") - 1).filter("_gap > 0")
    step = lambda at, before, after, status: F.struct(at.alias("n"), F.lit(before).alias("before") if isinstance(before, int) else before.alias("before"), F.lit(after).alias("after"), F.lit(status).alias("status"))
    steps = F.array_compact(F.array(
        step(F.col("n") + 1, 0, 1, "SUSPECT"), F.when(F.col("_gap") > 1, step(F.col("n") + 2, 1, 2, "EXCLUDED")),
        F.when(F.col("_next").isNotNull(), step(F.col("_next"), F.least(F.col("_gap"), F.lit(2)), 0, "REACTIVATED")),
    ))
    history = gaps.select(key, F.explode(steps).alias("s")).select(key, "s.*").join(small(valid), "n").select(key, "sweep", "before", "after", "status")
    open_ = gaps.filter("_next is null").select(key, F.least("_gap", F.lit(2)).alias("_c"), (F.col("n") + 1).alias("n")).join(small(valid), "n").select(key, "_c", F.col("sweep").alias("first_absent"))
    state = current.select(key).distinct().join(open_, key, "left").select(key, F.coalesce("_c", F.lit(0)).alias("confirmations"), "first_absent")
    return history, state


def identity_decision(counts: DataFrame) -> DataFrame:
    """counts (same_key, same_content, inactive; saturated at 2) with the class of an incoming identity."""
    k, c, i = (F.least(F.col(x), F.lit(2)) for x in ("same_key", "same_content", "inactive"))
    state = F.when((k > 1) | (c > 1), "QUARANTINE").when((k == 0) & (c == 0), "NEW").when((k == 1) & (c == 1) & (i == 1), "REACTIVATE").when((k == 1) & (c == 1), "REPLAY").when(k == 1, "VERSION").otherwise("ALIAS")
    return counts.withColumn("identity", state)


def link_reference(a: DataFrame, b: DataFrame, key: str, own: str, other: str) -> DataFrame:
    """a's time completed from b: COMPLEMENTED, RETAINED (equal or nothing to add), CONFLICT, ABSENT."""
    j = a.join(b.groupBy(key).agg(F.min(other).alias("_lo"), F.max(other).alias("_hi")), key, "left")
    state = F.when(F.col("_lo") != F.col("_hi"), "CONFLICT").when(F.col(own).isNull() & F.col("_lo").isNotNull(), "COMPLEMENTED").when(F.col(own).isNull(), "ABSENT").otherwise("RETAINED")
    return j.withColumn("outcome", state).withColumn(own, F.when(F.col("outcome") == "COMPLEMENTED", F.col("_lo")).otherwise(F.col(own))).drop("_lo", "_hi")


def link_checked(pairs: DataFrame, own: str, other: str, referred: Column, before: Sequence[tuple[str, Column]], after: Sequence[tuple[str, Column]]) -> DataFrame:
    """Each record with its bound reference, with outcome and its time.

    In this order: the first kind of before that holds (mismatches of execution, identity, window); without a reference
    RETAINED or REFERENCE_ABSENT, as the record has a time of its own or not; the first kind of after that holds (contract,
    status); without the reference's time RETAINED or REFERENCE_INVALID; SOURCE_TIME_CONFLICT where both times differ; else
    RETAINED or COMPLEMENTED. Only COMPLEMENTED takes the reference's time. A null condition doesn't hold.
    """
    native = F.col(own).isNotNull()
    kinds = lambda rules, state: functools.reduce(lambda s, r: F.when(F.coalesce(r[1], F.lit(False)), r[0]).otherwise(s), reversed(list(rules)), state)
    kept = lambda without: F.when(native, "RETAINED").otherwise(without)
    last = F.when(F.col(other).isNull(), kept("REFERENCE_INVALID")).when(native & (F.col(own) != F.col(other)), "SOURCE_TIME_CONFLICT").otherwise(kept("COMPLEMENTED"))
    state = kinds(before, F.when(~F.coalesce(referred, F.lit(False)), kept("REFERENCE_ABSENT")).otherwise(kinds(after, last)))
    return pairs.withColumn("outcome", state).withColumn(own, F.when(F.col("outcome") == "COMPLEMENTED", F.col(other)).otherwise(F.col(own)))


def days_to_recapture(changed: DataFrame, index: DataFrame, key: str, day: str) -> DataFrame:
    """Days of the index (key, day) that mention a changed key."""
    return index.join(changed.select(key).distinct(), key, "left_semi").select(day).distinct()


def affected_partitions(corrected: DataFrame, prior: DataFrame, key: str, part: str) -> DataFrame:
    """The partitions of the corrected rows and those where the same keys were before."""
    before = prior.join(corrected.select(key), key, "left_semi").select(part)
    return corrected.select(part).unionByName(before).distinct()


def illegal_transitions(events: DataFrame, keys: Sequence[str], order: Sequence[Column], state: str, allowed: DataFrame) -> DataFrame:
    """Steps from one state to the next that aren't in allowed (from_state, to_state)."""
    steps = events.withColumn("from_state", F.lag(state).over(Window.partitionBy(*keys).orderBy(*order))).withColumn("to_state", F.col(state)).filter("from_state is not null")
    return steps.join(small(allowed), ["from_state", "to_state"], "left_anti")
