"""What stands on disk while queries run, and that work in passes gives the rows of work at once."""

import contextlib
import datetime
import os
import time

from graylane import catalog
from graylane.operators import relations as R
from graylane.plans import marts_contracts as M


def _shuffle_mb(spark, seen=()):
    """{name: MB} of the session's shuffle files that aren't in seen."""
    found = {}
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString():
        for at, _, names in os.walk(top):
            for n in names:
                if n.startswith("shuffle_") and n not in seen:
                    with contextlib.suppress(OSError):
                        found[n] = os.path.getsize(f"{at}/{n}") / 1e6
    return found


def _left(spark, name, sf):
    """MB of shuffle files that stand once the query is built; Spark removes them in the background."""
    seen = _shuffle_mb(spark)
    held = catalog.QUERIES[name](spark, sf)
    for _ in range(40):
        left = sum(_shuffle_mb(spark, seen).values())
        if left < 0.05:
            break
        time.sleep(0.25)
    return left, held


def test_relations_free_their_shuffles(spark, sf):
    left, held = _left(spark, "resolve_relations", sf)
    assert left < 0.05 and held.columns  # the former operator left over 1 MB


def test_relations_in_passes(spark, monkeypatch):
    d = datetime.date(2024, 1, 1)
    edge = [
        (k, o, oc, t, tc, d if t == 3 else None, rev, card)
        for k, o, oc, t, tc, rev, card in [
            ("A", 1, 1, 2, 0, None, "MANY_TO_MANY"), ("A", 1, 1, 3, 0, 2, "MANY_TO_MANY"), ("A", 1, 1, 3, 0, 2, "MANY_TO_MANY"), ("A", 1, 1, 2, 0, 1, "MANY_TO_MANY"), ("A", 1, None, 2, 0, 1, "ONE_TO_ONE"),
            ("A", 1, None, 3, 0, 1, "ONE_TO_ONE"), ("A", None, 1, 2, 0, 1, "MANY_TO_MANY"), ("A", 4, 1, 2, 0, None, "ONE_TO_MANY"), ("A", 4, 1, 5, 0, 7, "MANY_TO_MANY"), ("A", 6, 1, 2, None, 1, "ONE_TO_MANY"),
            ("A", 7, 1, 2, None, 1, "ONE_TO_MANY"), ("A", 8, 1, 9, 0, 1, "ONE_TO_MANY"), ("B", 2, 0, 11, 5, 1, "MANY_TO_MANY"), ("B", 3, 0, 11, None, 1, "MANY_TO_MANY"), ("B", 9, 0, 12, 5, 1, "MANY_TO_MANY"), ("Z", 1, 1, 2, 0, 1, None),
        ]
    ]
    bindings = spark.createDataFrame(edge, "kind string, origin long, origin_component long, target long, target_component long, target_date date, revision long, cardinality string")
    roots = spark.createDataFrame([("o", k) for k in (1, 4, 6, 7, 8)] + [("t", k) for k in (2, 3, 5, 9)] + [("u", k) for k in (11, 12)], "entity string, id long")
    parts = spark.createDataFrame([("o", k, 1) for k in (1, 4, 6, 7, 8)] + [("t", k, 0) for k in (2, 3, 9)] + [("u", k, 5) for k in (11, 12)], "entity string, id long, component long")
    ends = spark.createDataFrame([("A", "o", "t", 0), ("B", "t", "u", None)], "kind string, origin_entity string, target_entity string, root_target long")
    many = "RESOLVED"
    want = {
        ("A", 1, 1, 2, 0, None): many, ("A", 1, 1, 3, 0, 2): many, ("A", 1, 1, 2, 0, 1): "SUPERSEDED", ("A", 1, None, 2, 0, 1): "CONFLICT", ("A", 1, None, 3, 0, 1): "COMPONENT_ABSENT",
        ("A", None, 1, 2, 0, 1): "ORIGIN_ABSENT", ("A", 4, 1, 2, 0, None): "CONFLICT", ("A", 4, 1, 5, 0, 7): "CONFLICT", ("A", 6, 1, 2, None, 1): many, ("A", 7, 1, 2, None, 1): many, ("A", 8, 1, 9, 0, 1): many,
        ("B", 2, 0, 11, 5, 1): many, ("B", 3, 0, 11, None, 1): "COMPONENT_ABSENT", ("B", 9, 0, 12, 5, 1): many, ("Z", 1, 1, 2, 0, 1): "ORIGIN_ABSENT",
    }
    monkeypatch.setattr(R, "PASS_ROWS", 2)  # three passes over the sixteen rows
    assert R._passes(len(edge), bindings.schema["origin"].dataType) == 3
    got = R.resolve_relations(bindings, roots, parts, ends, [("A", "B")]).collect()
    assert len(got) == len(want) and {tuple(r)[:5] + (r.revision,): r.disposition for r in got} == want


def test_revenue_frees_its_shuffles(spark, sf):
    left, held = _left(spark, "mart_revenue_facts", sf)
    assert left < 0.05 and held.columns  # the former mart left over 0.5 MB


def test_revenue_counts(spark):
    one = spark.sql("select 1L freight, 10.0bd value, 'done' status, true valid union all select 2L, 5.0bd, 'canceled', true union all select 3L, 1.0bd, 'done', true")
    terms = spark.sql("select freight, 'READY' state, date'2024-01-02' day, 'x' classification, false courtesy, true eligible, true active, 1 volumes, 7L payer from values (1L), (2L), (3L) as v(freight)")
    lines = spark.createDataFrame(
        [(1, 5, 1, None, False, None, "ok"), (1, 5, 2, False, False, None, "ok"), (1, 5, 2, False, None, None, None), (1, 6, 1, False, False, None, "ok"), (1, 6, None, False, False, None, "ok"), (1, None, 9, False, False, None, "ok"), (2, None, 1, None, None, "cte", "x"), (2, 4, None, None, None, None, "CANCELADO")],
        "freight long, invoice long, document long, conflict boolean, unresolved boolean, cte string, fiscal string",
    )
    places = spark.createDataFrame([(1, 1, 3, True), (1, 1, 3, True)], "freight long, location long, volumes int, valid boolean")
    days, payers = spark.sql("select date'2024-01-02' day, date'2024-01-03' billing"), spark.sql("select 7L payer, 'B' branch, date'2024-01-01' lo, date'2025-01-01' hi")
    got = {r.freight: (r.invoices, r.documents, r.cancelled_from, r.disposition, r.volumes) for r in M.revenue(one, terms, lines, places, days, payers).collect()}
    assert got == {1: (2, 3, "NONE", "READY", 3), 2: (1, 0, "INVOICE_AND_FREIGHT", "CANCELLED", 1), 3: (0, 0, "NONE", "DEPENDENCY_MISSING", 1)}
