"""Intervals, ranges, nested cohorts, absences, captures and column rules on literal rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from graylane.functions import scalar as S
from graylane.operators import aggregates as A
from graylane.operators import changes as H
from graylane.operators import intervals as I
from graylane.operators import joins as J
from graylane.operators import quality as Q
from graylane.streaming import jobs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("way", ["sent", "merged", "cut"])
def test_intervals_as_of(spark, monkeypatch, way):
    r = random.Random(7)
    intervals, facts = [], []
    for k in "abc":
        at = 0
        while at < 300:
            lo = at + r.randrange(0, 20)
            at = lo + r.randrange(0, 40)
            intervals.append((k, lo, at, f"{k}{lo}"))
    intervals += [("d", 5, 5000, "long"), (None, 0, 9000, "none")]
    facts = [(i, r.choice("aaabcdx"), r.randrange(0, 320)) for i in range(400)] + [(900, None, 4), (901, "a", None)]
    monkeypatch.setattr(I, "SMALL_ROWS", 10**6 if way == "sent" else 0)
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), F.col(c)).alias(c)
    side = spark.createDataFrame(intervals, "k string, lo int, hi int, name string").select("k", day("lo"), day("hi"), "name")
    fact = spark.createDataFrame(facts, "id int, k string, d int").select("id", "k", day("d"))
    if way == "cut":
        got = I.merged(fact, side.filter("lo < hi").dropna(), ["k"], "d", "lo", "hi", hot_rows=20)
    else:
        got = I.interval_join(fact, side, ["k"], "d", "lo", "hi")
    assert got.columns == ["id", "k", "d", "lo", "hi", "name"]
    want = {i: next((n for key, lo, hi, n in intervals if key == k and k is not None and d is not None and lo <= d < hi), None) for i, k, d in facts}
    found = [(x.id, x.name) for x in got.collect()]
    assert len(found) == len(facts) and dict(found) == want


def test_overlapping_intervals_are_reported(spark):
    side = spark.createDataFrame([("a", 1, 5, 1), ("a", 4, 6, 2), ("a", 6, 7, 3), ("a", 6, 6, 4), ("b", 1, 9, 5), ("b", 2, 3, 6), ("b", 3, 4, 7)], "k string, lo int, hi int, v int")
    assert rows(I.overlaps(side, ["k"], "lo", "hi")) == [("a", 4, 6, 5), ("b", 2, 3, 9), ("b", 3, 4, 9)]
    with pytest.raises(ValueError, match="overlap"):
        I.interval_join(spark.createDataFrame([("a", 1)], "k string, d int"), side, ["k"], "d", "lo", "hi")


def test_a_wide_range_is_a_few_bins(spark):
    ranges = [(3, 3), (0, 2**62 - 2), (-(2**62) + 1, 2**62 - 2), (7, 10**13 + 5), (-17, 23), (-9, -9), (-8, -1)]
    df = spark.createDataFrame(ranges, "lo long, hi long").select("lo", "hi", I.dyadic_bins(F.col("lo"), F.col("hi")).alias("b"))
    for r in df.collect():
        spans = sorted((b.bin << b.level, (b.bin + 1) << b.level) for b in r.b)
        assert spans[0][0] == r.lo and spans[-1][1] == r.hi + 1 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and len(spans) < 125
        assert r.hi - r.lo > 10**14 or len(spans) < 100


def test_ranges_and_names(spark):
    rules = [("RANGE", 2, 10, 2500, None, "r2"), ("RANGE", 1, 2000, 2100, None, "r1"), ("RANGE", 5, 0, 10**13, None, "r5"), ("RANGE", 0, 9, 3, None, "void"), ("RANGE", 4, -20, -3, None, "neg"), ("NAME", 0, None, None, "x", "n"), ("NAME", 0, None, None, "y", "m")]
    rules = spark.createDataFrame(rules, "kind string, priority long, lo long, hi long, label string, region string")
    fact = spark.createDataFrame([(-5, "x"), (-2, "x"), (10, "x"), (10, "x"), (2050, "y"), (2501, None), (None, "y"), (None, None)], "n long, s string")
    want = [(-5, "x", "neg"), (-2, "x", "n"), (10, "x", "r2"), (10, "x", "r2"), (2050, "y", "r1"), (2501, None, "r5"), (None, "y", "m"), (None, None, None)]
    assert rows(I.ranged_first(fact, rules, "n", "s")) == sorted(want, key=repr)
    assert rows(I.ranged_first(fact, rules.filter("kind = 'NAME'"), "n", "s").select("region").distinct()) == sorted([("n",), ("m",), (None,)], key=repr)


def test_nested_cohorts(spark):
    data = [
        ("r1", 2, "done", 1, 5, "c1", "x"), ("r1", 2, "open", 1, None, "c1", "x"), ("r1", 2, "done", 1, 5, "c2", "p"), ("r1", 2, "done", 1, 5, "c2", "q"), ("r1", 1, "odd", 9, 9, "c9", "x"), ("r1", 2, "done", 1, 5, None, "z"),
        ("r2", 1, "odd", None, 1, "c1", None), ("r2", 1, "odd", 2, 2, "c1", "v"), ("r3", 1, "odd", None, None, None, None), ("r4", 1, "odd", 1, 1, "c", "a"), ("r4", 1, "open", 1, 1, "c", "a"), ("r5", 1, None, 1, 1, "c", "a"), ("r5", 1, "open", 1, 1, "c", "a"),
    ]
    df = spark.createDataFrame(data, "k string, f int, st string, a int, m int, child string, attr string")
    roots, children = A.reduce_nested(df, ["k"], [F.desc("f")], ["a"], ["m"], "st", ["open", "done"], "child", ["attr"])
    got = {r.k: (r.cohort, r.a_state, r.a, r.m_state, r.m, r.st_state, r.st, r.children, r.quarantined, r.conflict) for r in roots.collect()}
    assert got == {
        "r1": (5, "VALUE", 1, "VALUE", 5, "VALUE", "open", 1, 1, False), "r2": (2, "CONFLICT", None, "CONFLICT", None, "VALUE", "odd", 0, 1, True), "r3": (1, "NULL", None, "NULL", None, "VALUE", "odd", 0, 0, False),
        "r4": (2, "VALUE", 1, "VALUE", 1, "CONFLICT", None, 1, 0, True), "r5": (2, "VALUE", 1, "VALUE", 1, "CONFLICT", None, 1, 0, True),
    }
    assert rows(children.select("k", "child", "copies", "attr", "disposition")) == [("r1", "c1", 2, "x", "ACCEPTED"), ("r1", "c2", 2, None, "QUARANTINE"), ("r2", "c1", 2, None, "QUARANTINE"), ("r4", "c", 2, "a", "ACCEPTED"), ("r5", "c", 2, "a", "ACCEPTED")]


def test_absences_need_evidence(spark):
    sweeps = [(1, 1, "p1", "s", True, True), (2, 2, "p2", "s", False, True), (3, 3, "p1", "s", True, True), (4, 4, "p4", "other", True, True), (5, 5, "p5", "s", True, None), (6, 6, "p6", "s", True, True), (7, 7, "p7", "s", True, True), (8, 8, None, "s", True, True)]
    sweeps = spark.createDataFrame(sweeps, "sweep long, at long, capture string, scope string, complete boolean, eligible boolean")
    assert rows(H.counted_sweeps(sweeps)) == [(1, 1), (6, 2), (7, 3)]
    current = spark.createDataFrame([("never",), ("once",), ("back",), ("always",)], "k string")
    seen = [(s, "always") for s in range(1, 9)] + [(1, "once"), (6, "once"), (7, "back"), (2, "never"), (3, "never"), (4, "never"), (6, "stranger")]
    history, state = H.absence_history(current, spark.createDataFrame(seen, "sweep long, k string"), sweeps, "k")
    assert rows(history.select("k", "sweep", "before", "after", "status")) == [("back", 1, 0, 1, "SUSPECT"), ("back", 6, 1, 2, "EXCLUDED"), ("back", 7, 2, 0, "REACTIVATED"), ("never", 1, 0, 1, "SUSPECT"), ("never", 6, 1, 2, "EXCLUDED"), ("once", 7, 0, 1, "SUSPECT")]
    assert rows(state) == [("always", 0, None), ("back", 0, None), ("never", 2, 1), ("once", 1, 7)]
    assert rows(H.absence_history(current, spark.createDataFrame(seen, "sweep long, k string"), sweeps.limit(0), "k")[1].select("confirmations").distinct()) == [(0,)]


def capture(run, day, stated, keys, start=1, **broken):
    record = lambda k: {"id": k, "day": broken.get("says", day)} | broken.get("also", {})
    return [{"run": run, "business_date": day, "expected": stated, "ordinal": i, "envelope": json.dumps({"record": record(k)})} for i, k in enumerate(keys, start)]


def test_captures_land_whole_and_once(spark, tmp_path):
    good, half, late = capture("good", "2024-01-01", 3, [1, 2, 3]), capture("half", "2024-01-01", 4, [1, 2]), capture("half", "2024-01-01", 4, [3, 4], 3)
    batches = [
        [*good, *half, *half[:1], *capture("field", "2024-01-01", 2, [1, 2], also={"x": 1})],
        [*late, *capture("days", "2024-01-02", 2, [1, 2], says="2024-01-01"), *capture("keys", "2024-01-01", 2, [7, 7]), *capture("more", "2024-01-01", 1, [1, 2])],
        [*good, *capture("none", "2024-01-01", 9, [1]), *capture("two", "2024-01-01", 1, [1]), *capture("two", "2024-01-01", 2, [2], 2), *capture("field", "2024-01-01", 2, [1, 2])],
    ]
    for k, batch in enumerate(batches):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(map(json.dumps, batch)))
        for _ in range(2):
            jobs.stream_landing(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/chk", ["id", "day"], "id", "day")
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{tmp_path}/out/{name}")
    assert rows(read("decisions", "run string, decision string, batch long")) == sorted([
        ("good", "ACCEPTED", 0), ("field", "REJECTED", 0), ("half", "ACCEPTED", 1), ("days", "REJECTED", 1), ("keys", "REJECTED", 1), ("more", "REJECTED", 1), ("good", "REPLAY", 2), ("two", "REJECTED", 2), ("field", "REPLAY", 2)], key=repr)
    assert rows(read("bronze", jobs.CAPTURE).groupBy("run").count()) == [("good", 3), ("half", 4)]
    assert rows(read("violations", "run string, code string, n long").select("run", "code", "n")) == [("days", "DAY", 2), ("field", "FIELDS", 2), ("keys", "DUPLICATE_KEY", 1), ("more", "COUNT", 1), ("two", "COUNT", 3)]
    assert rows(spark.read.schema(jobs.CAPTURE).parquet(f"{tmp_path}/out/open/batch=2").select("run")) == [("none",)]
    assert rows(read("quarantine", jobs.CAPTURE).groupBy("run").count()) == [("days", 2), ("field", 2), ("keys", 2), ("more", 2), ("two", 2)]


@pytest.mark.parametrize(("text", "tokens", "want"), [
    ("São Paulo", ["SÃO", "paulo"], True), ("São Paulo", ["são", "páulo"], True), ("Paulo São", ["sao", "paulo"], False), ("Łódź ŷ ǎ", ["y", "A"], True), ("ab", ["ab", "b"], False), ("áb b", ["ab", "b"], True),
    (None, ["a"], False), ("", ["a"], False), ("comprovante da entrega anexado", ["comprovante", "entrega", "anexado"], True), ("comprovantentrega anexado", ["comprovante", "entrega"], False),
])
def test_tokens_in_order(spark, text, tokens, want):
    assert one(spark, lambda c: S.contains_tokens(c, tokens), text) is want


def test_aliases_ignore_case_and_accents(spark):
    fact = spark.createDataFrame([("São paulo",), ("SÃO PAULO",), ("ǎ",), ("b",), (None,)], "x string")
    entities = spark.createDataFrame([(2, ["são Paulo"]), (1, ["SAO PAULO", "A"])], "k int, names array<string>")
    assert sorted((r.x or "", r.k) for r in J.alias_join(fact, entities, "x", "names", ["k"], S.folded).collect()) == sorted([("São paulo", 1), ("SÃO PAULO", 1), ("ǎ", 1), ("b", None), ("", None)], key=str)


@pytest.mark.parametrize(("text", "want"), [("12", "VALID"), ("12\n", "INVALID"), ("\n12", "INVALID"), ("1.1234567891", "INVALID"), ("٣", "INVALID"), ("-0.5", "VALID"), ("", "INVALID"), (None, "ABSENT")])
def test_strict_numbers(spark, text, want):
    assert one(spark, S.strict_number, text).state == want
    assert one(spark, lambda c: S.strict_number(c, F.lit("NULL")), text).state == (want if text is not None else "NULL")


@pytest.mark.parametrize(("text", "want"), [("a", True), ("a\n", False), (" a", False), ("a b", True), ("x" * 100, True), ("x" * 101, False), ("", False), (None, False)])
def test_typed_keys(spark, text, want):
    assert one(spark, lambda c: S.typed_key("k", c), text).valid is want


def test_object_hashes_tell_objects_apart(spark):
    texts = ['{"a":"1|b=2"}', '{"a":"1","b":"2"}', '{"a":1,"b":2}', '{"a":{"x":1,"y":2}}', '{"a":"{\\"x\\":1,\\"y\\":2}"}', '{"a":null}', "{}", '{"a":[1,2]}', '{"a":[2,1]}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(S.stable_json_hash(F.col("t")).alias("h"))
    assert df.distinct().count() == len(texts) and df.filter("h is null").count() == 0
    same = spark.createDataFrame([('{"a":{"y":[{"q":1,"p":2}],"x":1},"s":7}',), ('{ "s":8, "a":{"x":1,"y":[{"p":2,"q":1}]} }',)], "t string")
    assert same.select(S.stable_json_hash(F.col("t"), ["s"])).distinct().count() == 1
    assert one(spark, S.stable_json_hash, "no json") is None and one(spark, S.stable_json_hash, None) is None


@pytest.mark.parametrize(("minutes", "want"), [(0, "00:00"), (43_200, "720:00"), (43_201, None), (-1, None), (61, "01:01"), (None, None)])
def test_durations(spark, minutes, want):
    assert one(spark, S.duration_text, minutes, "long") == want


def test_transit_falls_back_by_the_clock(spark):
    data = [(5, None, None, None), (43_201, "2024-01-01 00:00:59", "2024-01-01 00:01:00", "2024-02-01 00:00:00"), (None, "2024-01-01 00:00:00", None, "2024-01-31 00:00:00"), (-1, "2024-01-01 00:00:00", None, "2024-01-31 00:01:00"), (None, "2024-01-02 00:00:00", "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(data, "m long, s string, a string, e string")
    got = [tuple(r) for r in df.select(*S.transit_minutes(F.col("m"), *[F.col(c).cast("timestamp") for c in "sae"])).collect()]
    assert got == [(5, "DIRECT", False), (1, "PREDICTED_DIFFERENCE", True), (43_200, "PREDICTED_DIFFERENCE", False), (None, "INVALID_OR_ABSENT", True), (None, "INVALID_OR_ABSENT", False)]


def test_units_are_screened(spark):
    data = [(1, "r", "a", 1, "x", "BRL"), (2, "r", "a", 1, "x", "BRL"), (3, "r", "b", 0, "y", "USD"), (4, "r", "b", 1, "y", "BRL"), (5, "s", "a", 1, "x", None), (6, "s", "b", 1, "x", "BRL"), (7, "t", "a", 1, "x", "BRL"), (8, None, "a", 1, "x", "BRL")]
    df = spark.createDataFrame(data, "o int, root string, k string, f int, c string, unit string")
    stored = spark.createDataFrame([("s", "BRL"), ("t", "EUR")], "root string, unit string")
    got = {r.o: r.disposition for r in H.screen_batch(df, ["root", "k"], "f", "c", "o", ["root"], ["unit"], stored).collect()}
    assert got == {1: "QUARANTINE_UNIT", 2: "DUPLICATE", 3: "STALE", 4: "QUARANTINE_UNIT", 5: "ACCEPT", 6: "ACCEPT", 7: "QUARANTINE_UNIT", 8: "ACCEPT"}


def test_page_evidence_names_the_first_fault(spark):
    pages = [("ok", 1, 5, False), ("ok", 2, 0, True), ("gap", 1, 5, False), ("gap", 3, 0, True), ("twice", 1, 5, False), ("twice", 1, 5, False), ("twice", 2, 0, True), ("sum", 1, 4, False), ("sum", 2, 0, True), ("end", 1, 5, False), ("end", 2, 0, False), ("full", 1, 3, False), ("full", 2, 2, True), ("early", 1, 0, False), ("early", 2, 5, False), ("early", 3, 0, True), ("marks", 1, 5, True), ("marks", 2, 0, True)]
    stated = [(k, 5, 3 if k in ("early", "twice") else 2) for k in ("ok", "gap", "twice", "sum", "end", "full", "early", "marks", "void")]
    out = Q.page_evidence(spark.createDataFrame(pages, "run string, page long, rows long, terminal boolean"), spark.createDataFrame(stated, "run string, rows long, pages long"), "run", "page", "rows", "terminal")
    assert {r.run: r.fault for r in out.collect()} == {"ok": None, "gap": "GAPS", "twice": "GAPS", "sum": "SUM", "end": "TERMINAL", "full": "NOT_EMPTY", "early": "EARLY_EMPTY", "marks": "TERMINAL", "void": "NO_PAGES"}
