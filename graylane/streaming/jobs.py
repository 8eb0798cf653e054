"""Structured Streaming jobs: continuous landing, continuous current state, deduplication of overlapping reads."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graylane import storage
from graylane.operators.changes import decide, screen_batch
from graylane.operators.windows import latest_per_key
from graylane.sources.landing import check_captures

#: Micro-batches after which the state is written whole.
SNAPSHOT_EVERY = 20


def stream_captures(spark: SparkSession, path: str, schema: str, good: Column, out: str, checkpoint: str) -> None:
    """New JSON files: rows that meet the contract to out/bronze, the others to out/quarantine; each batch writes its own folder, so a replay overwrites it."""

    def land(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("_ok", F.coalesce(good, F.lit(False)))
        marked.filter("_ok").drop("_ok").write.mode("overwrite").parquet(f"{out}/bronze/batch={batch_id}")
        marked.filter("not _ok").drop("_ok").write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).json(path)
    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


CAPTURE = "run string, business_date date, expected long, ordinal long, envelope string"


def stream_landing(spark: SparkSession, path: str, out: str, checkpoint: str, fields: list[str], key: str, day: str, zone: str | None = None, files: int = 64) -> None:
    """New JSON files of captures (CAPTURE), each landed whole or not at all, once.

    A capture's rows may come in several files and batches: they wait in out/open until there are as many as it states, a
    row that comes again (same ordinal and envelope) counting once. Then check_captures decides: out/bronze gets all its
    rows, or out/quarantine; out/violations says why by code and out/decisions has ACCEPTED, REJECTED (as soon as a
    violation other than missing rows is found) and REPLAY (rows of a run that an earlier batch decided, which are left
    out). A batch depends on earlier batches alone and writes folders of its own, so a replayed batch writes the same again.
    """

    def land(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        before = [spark.read.schema(CAPTURE).parquet(f"{out}/open/batch={n - 1}")] if n else []
        rows = functools.reduce(DataFrame.unionByName, before, batch).dropDuplicates(["run", "ordinal", "envelope"])
        rows = storage.written(rows, "stream-captures")
        decided = spark.read.schema("run string, decision string, batch long").parquet(f"{out}/decisions").filter((F.col("batch") < n) & (F.col("decision") != "REPLAY")).select("run") if n else rows.select("run").limit(0)
        fresh = rows.join(decided, "run", "left_anti")
        found = storage.written(check_captures(fresh, "run", "envelope", fields, key, day, "expected", zone), "stream-violations")
        sizes = fresh.groupBy("run").agg(F.count(F.lit(1)).alias("_rows"), F.max("expected").alias("_expected"), F.coalesce(F.min("expected") == F.max("expected"), F.lit(False)).alias("_one"))
        short = F.col("_one") & (F.col("_rows") < F.col("_expected"))
        wrong = found.filter("code != 'COUNT'").select("run", F.lit(True).alias("_wrong")).distinct()
        state = F.when(F.col("_wrong").isNotNull(), "REJECTED").when(short, "OPEN").when(F.col("_one") & (F.col("_rows") == F.col("_expected")), "ACCEPTED").otherwise("REJECTED")
        decisions = storage.written(sizes.join(wrong, "run", "left").select("run", state.alias("decision")), "stream-decisions")
        of = lambda d: fresh.join(decisions.filter(F.col("decision") == d), "run", "left_semi")
        for name, decision in (("bronze", "ACCEPTED"), ("quarantine", "REJECTED"), ("open", "OPEN")):
            of(decision).select(*batch.columns).write.mode("overwrite").parquet(f"{out}/{name}/batch={n}")
        found.join(decisions.filter("decision = 'REJECTED'"), "run", "left_semi").write.mode("overwrite").parquet(f"{out}/violations/batch={n}")
        again = rows.join(decided, "run", "left_semi").select("run", F.lit("REPLAY").alias("decision")).distinct()
        decisions.filter("decision != 'OPEN'").unionByName(again).write.mode("overwrite").parquet(f"{out}/decisions/batch={n}")

    stream = spark.readStream.schema(CAPTURE).option("maxFilesPerTrigger", files).json(path)
    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current_state(spark: SparkSession, out: str, key: str, freshness: str, content: str, before: int | None = None) -> DataFrame:
    """The state of stream_apply after the batches below before (all of them where it is None): the last snapshot and the accepted rows since."""
    log = spark.read.parquet(f"{out}/decisions")
    if before is None:
        before = log.agg(F.max("batch")).first()[0] + 1
    last = (before - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    since = log.filter((F.col("batch") >= last) & (F.col("batch") < before) & F.col("decision").isin("INSERT", "UPDATE")).select(key, freshness, content)
    rows = since.unionByName(spark.read.parquet(f"{out}/snapshots/before={last}").select(key, freshness, content)) if last else since
    return latest_per_key(rows, [key], [F.desc_nulls_last(freshness)])


def stream_apply(stream: DataFrame, key: str, freshness: str, content: str, ordinal: str, out: str, checkpoint: str) -> None:
    """Current state by micro-batch: out/decisions has a decision for every row of every batch, current_state reads the state.

    A batch is screened (STALE, DUPLICATE and QUARANTINE rows of its own), what it accepts is decided against the state
    before it: INSERT, UPDATE, STALE, REPLAY, CONFLICT (other content at the same freshness) or NULL_FRESHNESS. A batch
    writes its own decisions only, and depends on earlier batches alone, so that a replayed batch writes the same again;
    every SNAPSHOT_EVERY batches the state is written whole.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        screened = screen_batch(batch, [key], freshness, content, ordinal)
        fresh = screened.filter("disposition = 'ACCEPT'").select(key, freshness, content)
        state = current_state(spark, out, key, freshness, content, batch_id).join(fresh.select(key), key, "left_semi") if batch_id else fresh.limit(0)
        decided = decide(state, fresh, key, freshness, content).select(key, F.col(f"new_{freshness}").alias(freshness), F.col(f"new_{content}").alias(content), "decision")
        others = screened.filter("disposition != 'ACCEPT'").select(key, freshness, content, F.col("disposition").alias("decision"))
        decided.unionByName(others).write.mode("overwrite").parquet(f"{out}/decisions/batch={batch_id}")
        if (batch_id + 1) % SNAPSHOT_EVERY == 0:
            current_state(spark, out, key, freshness, content, batch_id + 1).write.mode("overwrite").parquet(f"{out}/snapshots/before={batch_id + 1}")

    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_dedupe(stream: DataFrame, keys: list[str], ts: str, delay: str, out: str, checkpoint: str) -> None:
    """Repeats of a key within the delay go, such as those of reads that overlap."""
    once = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    once.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
