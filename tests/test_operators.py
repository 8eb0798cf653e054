"""Ties, nulls and conflicts on literal rows."""

import pytest
from pyspark.sql import functions as F

from graylane.functions import scalar as S
from graylane.operators import aggregates as A
from graylane.operators import changes as H
from graylane.operators import joins as J
from graylane.operators import quality as Q
from graylane.operators import windows as W
from graylane.sources import landing as L
from graylane.streaming import jobs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("text", "want"), [("R$ 1,234.50", 1234.5), ("-7", -7), ("  ", None), ("12x", None), (None, None), ("1.005", 1.01), ("€5", 5)])
def test_parse_decimal(spark, text, want):
    got = one(spark, lambda c: S.parse_decimal(c, 18, 2), text)
    assert (float(got) if got is not None else None) == want


@pytest.mark.parametrize(("days", "want"), [(-9, "-4 or less"), (-4, "-4 or less"), (-3, "-3"), (0, "0"), (1, "+1"), (4, "+4 or more"), (None, None)])
def test_delay_band(spark, days, want):
    assert one(spark, S.delay_band, days, "int") == want


def test_strict_freshness_does_not_fall_through(spark):
    df = spark.createDataFrame([("bad", "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00"), (None, None)], "a string, b string")
    got = [r.f for r in df.select(S.freshness_strict([("a", F.col("a")), ("b", F.col("b"))]).alias("f")).collect()]
    assert [(g.origin, g.reason) for g in got] == [("a", "INVALID"), ("b", "OK"), (None, "MISSING")]


def test_framed_hash_tells_rows_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "-1:")], "x string, y string")
    assert df.select(S.framed_hash(["x", "y"]).alias("h")).distinct().count() == 4


def test_decisions(spark):
    cur = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (3, 5, "a"), (4, 5, "a"), (5, None, "a"), (6, 5, "a"), (7, None, "a")], "k int, f int, c string")
    inc = spark.createDataFrame([(1, 6, "b"), (2, 4, "b"), (3, 5, "a"), (4, 5, "b"), (5, 1, "b"), (7, None, "a"), (8, 1, "z")], "k int, f int, c string")
    got = {r.k: r.decision for r in H.decide(cur, inc, "k", "f", "c").collect()}
    assert got == {1: "UPDATE", 2: "STALE", 3: "REPLAY", 4: "CONFLICT", 5: "NULL_FRESHNESS", 6: "KEEP", 7: "REPLAY", 8: "INSERT"}
    assert {r.k: r.c for r in H.apply_changes(cur, inc, "k", "f", "c").collect()} == {1: "b", 2: "a", 3: "a", 4: "a", 5: "a", 6: "a", 7: "a", 8: "z"}


def test_absence_needs_two_confirmations(spark):
    cur, seen = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int")
    state = spark.createDataFrame([], "k int, confirmations int")
    steps = []
    for s in (seen, seen, spark.createDataFrame([(1,), (2,)], "k int")):
        state = spark.createDataFrame(H.absence_sweep(cur, s, state, "k").collect(), "k int, confirmations int, status string")
        steps.append({r.k: r.status for r in state.collect()}[2])
    assert steps == ["SUSPECT", "EXCLUDED", "REACTIVATED"]


def test_screen_batch(spark):
    df = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "a", 2), (1, 2, "a", 3), (2, 1, "a", 4), (2, 1, "b", 5), (3, None, "a", 6)], "k int, f int, c string, o int")
    assert {r.o: r.disposition for r in H.screen_batch(df, ["k"], "f", "c", "o").collect()} == {1: "STALE", 2: "ACCEPT", 3: "DUPLICATE", 4: "QUARANTINE", 5: "QUARANTINE", 6: "ACCEPT"}


def test_incremental_equals_full(spark):
    old = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 3, 1), (3, 9, 1)], "k int, id int, f int")
    new = spark.createDataFrame([(1, 1, 1), (2, 3, 1), (2, 4, 5), (4, 7, 1)], "k int, id int, f int")
    order = [F.desc("f"), F.desc("id")]
    state = W.latest_per_key(old, ["k"], order).select("k", "id").withColumn("active", F.lit(True))
    got = H.refresh_winners(state, new, old.unionByName(new).select("k"), ["k"], order)
    assert rows(got.filter("active").select("k", "id")) == rows(W.latest_per_key(new, ["k"], order).select("k", "id"))
    assert rows(got.filter("not active").select("k")) == [(3,)]


@pytest.mark.parametrize("total", [100.0, 0.05, -10.0, 0.0])
@pytest.mark.parametrize("weights", [[1, 1, 1], [0, 0, 0], [3, 0, 7], [None, 1, 2]])
def test_allocation_adds_up(spark, total, weights):
    df = spark.createDataFrame([(1, i, total, w) for i, w in enumerate(weights)], "k int, i int, t double, w int")
    got = [float(r.share) for r in W.allocate(df, ["k"], F.col("t"), F.col("w"), [F.asc("i")]).collect()]
    assert round(sum(got), 2) == round(total, 2)


def test_consensus(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "a"), (2, "b"), (3, None)], "k int, v string")
    assert rows(A.consensus(df, ["k"], "v")) == [(1, "VALUE", "a"), (2, "CONFLICT", None), (3, "NULL", None)]


def test_bounds_and_contracts_raise(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert W.bounded(df, [F.asc("k")], 2).count() == 2
    with pytest.raises(ValueError, match="more than 1"):
        W.bounded(df, [F.asc("k")], 1)
    with pytest.raises(ValueError, match="other than the contract"):
        L.read_contract(df, spark.createDataFrame([], "k long").schema, F.lit(True), [F.asc("k")], 9)
    stored = spark.createDataFrame([(1, "a")], "release int, v string")
    assert rows(L.import_release(stored, spark.createDataFrame([(1, "a"), (2, "c")], "release int, v string"), "release")) == [(2, "c")]
    with pytest.raises(ValueError, match="other rows"):
        L.import_release(stored, spark.createDataFrame([(1, "x")], "release int, v string"), "release")


def test_row_diff_kinds(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "c"), (3, "n"), (5, "y")], "k int, v string")
    assert {(r.k, r.kind) for r in Q.row_diff(a, b, "k", ["v"]).collect()} == {(2, "VALUE"), (3, "NULLABILITY"), (4, "MISSING"), (5, "EXTRA")}


def test_whole_texts_are_read(spark, tmp_path):
    from graylane import catalog

    text = " ".join(["b"] * 400 + ["a", "b", "c"])
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.QUERIES["canonical_list"](spark, str(tmp_path)).collect()[0].words == ",".join(sorted(text.split(" ")))
    assert {r.word: r.pos for r in catalog.QUERIES["last_wins"](spark, str(tmp_path)).collect()} == {"a": 400, "b": 401, "c": 402}


def test_stream_keeps_conflicts_and_restarts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "SNAPSHOT_EVERY", 2)
    schema = "id long, f long, c string, o long"
    batches = [[(1, 1, "b", 0), (2, 1, "x", 1), (3, None, "n", 2)], [(1, 1, "a", 0), (2, 2, "y", 1), (2, 1, "w", 2)], [(2, 2, "y", 0), (1, 0, "old", 1), (4, 1, "p", 2), (4, 1, "q", 3)], [(3, 5, "late", 0)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        for _ in range(1 + k % 2):  # also again without new rows
            jobs.stream_apply(stream, "id", "f", "c", "o", f"{tmp_path}/out", f"{tmp_path}/chk")
    state = {r.id: (r.f, r.c) for r in jobs.current_state(spark, f"{tmp_path}/out", "id", "f", "c").collect()}
    assert state == {1: (1, "b"), 2: (2, "y"), 3: (None, "n")}
    log = sorted((r.batch, r.id, r.decision) for r in spark.read.parquet(f"{tmp_path}/out/decisions").collect())
    assert log == [(0, 1, "INSERT"), (0, 2, "INSERT"), (0, 3, "INSERT"), (1, 1, "CONFLICT"), (1, 2, "STALE"), (1, 2, "UPDATE"), (2, 1, "STALE"), (2, 2, "REPLAY"), (2, 4, "QUARANTINE"), (2, 4, "QUARANTINE"), (3, 3, "NULL_FRESHNESS")]


def test_a_capture_is_landed_whole_and_once(spark, tmp_path):
    bad = spark.createDataFrame([("COUNT", 1)], "code string, n long")
    with pytest.raises(ValueError):
        L.land_capture(bad, bad, f"{tmp_path}/x", "r1")
    for run in ("r1", "r1", "r2"):
        L.land_capture(bad, bad.limit(0), f"{tmp_path}/x", run)
    assert sorted(r.run for r in spark.read.parquet(f"{tmp_path}/x").collect()) == ["r1", "r2"]


def test_a_receipt_for_other_inputs_is_refused(spark):
    decisions = spark.createDataFrame([("INSERT",)], "decision string")
    kept = spark.createDataFrame([("r", 2, 0, 0, 0)], "receipt string, inserts long, updates long, noops long, blocked long")
    with pytest.raises(ValueError):
        H.accepted_receipt(decisions, kept, "r")
    assert H.accepted_receipt(decisions, kept.withColumn("inserts", F.lit(1).cast("long")), "r").first().status == "REPLAY"
