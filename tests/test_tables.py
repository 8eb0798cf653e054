"""Published and marked tables, keyed synchronisation, incremental detail and relations on literal rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from graylane.operators import changes as H
from graylane.operators import relations as R
from graylane.sources import landing as L
from graylane.sources import marked, versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_publications_win_or_leave_nothing(spark, tmp_path):
    base, df = f"file://{tmp_path}/p", spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ValueError):
        versions.read(spark, base, "t")
    assert versions.publish(spark, base, {"t": df, "u": df.limit(0)}) == 1
    assert rows(versions.read(spark, base, "t")) == [(1, "a")] and rows(versions.read(spark, base, "u")) == []
    with pytest.raises(versions.Lost):
        versions.commit(spark, base, 0, {"folder": "other"})
    assert versions.current(spark, base)[0] == 1 and [n for n in versions.listed(spark, base) if n.startswith("_new")] == []
    with pytest.raises(Exception, match="boom"):
        versions.publish(spark, base, {"t": df, "u": df.select(F.raise_error(F.lit("boom")).cast("long").alias("x"))})
    assert len(versions.listed(spark, f"{base}/versions")) == 1 and versions.current(spark, base)[0] == 1
    for k in range(3):
        versions.publish(spark, base, {"t": df.withColumn("k", F.lit(k).cast("long"))}, keep=2)
    assert len(versions.listed(spark, f"{base}/versions")) == 2 and rows(versions.read(spark, base, "t")) == [(2, "a")]


def _days(spark, base, rows=(("a", "x", 1), ("a", "x", 2), ("b", None, 3), (None, "y", 4))):
    df = spark.createDataFrame(list(rows), "day string, scope string, v long")
    marked.create(spark, base, df.schema, ["day", "scope"], spark.createDataFrame([], "run long").schema)
    runs = df.groupBy("day", "scope").agg(F.count(F.lit(1)).alias("rows")).withColumn("run", F.lit(1).cast("long"))
    marked.replace(spark, base, df, runs.select("day", "scope", "run"))
    return df, runs


def test_a_replacement_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    base = f"file://{tmp_path}/t"
    df, runs = _days(spark, base)
    assert rows(marked.read(spark, base)) == rows(df)

    def dies(*_):
        raise KeyboardInterrupt  # after rows and marks were written, before the commit; nothing cleans up

    monkeypatch.setattr(versions, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        marked.replace(spark, base, df.withColumn("v", F.lit(0).cast("long")), runs.select("day", "scope", "run"))
    monkeypatch.undo()
    assert rows(marked.read(spark, base)) == rows(df) and len(versions.listed(spark, f"{base}/rows")) == 2
    marked.replace(spark, base, df.limit(0), runs.filter("day = 'a'").select("day", "scope", "run"))
    assert rows(marked.read(spark, base)) == [("b", None, 3), (None, "y", 4)]
    marked.vacuum(spark, base)
    assert rows(marked.read(spark, base)) == [("b", None, 3), (None, "y", 4)]
    assert len(versions.listed(spark, f"{base}/rows")) == 2 and len(versions.listed(spark, f"{base}/marks")) == 1  # the first rows and the empty replacement


def test_two_writers_of_one_table(spark, tmp_path):
    base = f"file://{tmp_path}/t"
    df, runs = _days(spark, base)
    seen = versions.current(spark, base)[0]
    marked.replace(spark, base, df.filter("day = 'a'").withColumn("v", F.lit(7).cast("long")), runs.filter("day = 'a'").select("day", "scope", "run"), seen)
    with pytest.raises(versions.Lost):
        marked.replace(spark, base, df.limit(0), runs.select("day", "scope", "run"), seen)
    assert rows(marked.read(spark, base).filter("day = 'a'").select("v")) == [(7,), (7,)]


def test_emptied_and_removed_partitions(spark, tmp_path):
    base = f"file://{tmp_path}/t"
    df, runs = _days(spark, base, [("a", "x", 1), ("a", "x", 2), ("b", "x", 3), ("c", "x", 4), ("d", "x", 5)])
    run = F.when(F.col("day").isin("a", "b"), 2).otherwise(1).cast("long")
    covered = runs.filter("day != 'c'").withColumn("run", run).select("day", "scope", "run")
    stated = spark.createDataFrame([("b", "x", 1), ("a", "x", 0)], "day string, scope string, rows long")
    pending = H.replace_partitions(base, df.filter("day = 'b'").withColumn("v", F.lit(9).cast("long")), covered, "run", stated)
    assert rows(pending.select("day", "run")) == [("a", 2), ("b", 2), ("c", None)]
    assert rows(marked.read(spark, base)) == [("b", "x", 9), ("d", "x", 5)]
    assert rows(marked.marks(spark, base).select("day", "run")) == [("a", 2), ("b", 2), ("d", 1)]
    again = covered.withColumn("run", F.col("run") + 1)
    with pytest.raises(ValueError):
        H.replace_partitions(base, df, again, "run", stated)
    assert rows(marked.read(spark, base)) == [("b", "x", 9), ("d", "x", 5)]
    assert H.replace_partitions(base, df, covered, "run", stated).isEmpty()


def test_rows_that_move_stand_once(spark, tmp_path):
    base = f"file://{tmp_path}/s"
    first = spark.createDataFrame([(1, "2024-01-05", 5), (2, "2024-02-05", 5), (3, "2024-02-06", 5), (4, "2024-02-07", 5), (5, "2024-03-01", 5), (6, None, 1)], "k long, d string, v long").selectExpr("k", "cast(d as date) as d", "v").withColumn("m", F.date_format("d", "yyyy-MM"))
    marked.create(spark, base, first.schema, ["m"])
    marked.replace(spark, base, first, first.select("m").distinct())
    source = spark.createDataFrame([(1, "2024-02-20", 5), (2, "2024-02-05", 5), (3, "2024-02-09", 6), (7, "2024-02-11", 1)], "k long, d string, v long").selectExpr("k", "cast(d as date) as d", "v")
    lo, hi, month = F.lit("2024-02-01").cast("date"), F.lit("2024-02-29").cast("date"), F.date_format("d", "yyyy-MM")
    for stated in ((4, 16), (3, 17)):
        with pytest.raises(ValueError):
            L.sync_keyed(base, source, "k", "d", month, lo, hi, "v", *stated)
    with pytest.raises(ValueError):
        L.sync_keyed(base, source.unionByName(source.filter("k = 7").withColumn("v", F.lit(0).cast("long"))), "k", "d", month, lo, hi, "v", 5, 17)
    assert L.sync_keyed(base, source, "k", "d", month, lo, hi, "v", 4, 17) == {"UPDATE": 2, "KEEP": 1, "INSERT": 1, "DELETE": 1}
    got = marked.read(spark, base).selectExpr("k", "cast(d as string) as d", "v", "m")
    want = [(1, "2024-02-20", 5, "2024-02"), (2, "2024-02-05", 5, "2024-02"), (3, "2024-02-09", 6, "2024-02"), (5, "2024-03-01", 5, "2024-03"), (6, None, 1, None), (7, "2024-02-11", 1, "2024-02")]
    assert rows(got) == sorted(want, key=repr)
    before = versions.current(spark, base)[0]
    assert L.sync_keyed(base, source, "k", "d", month, lo, hi, "v", 4, 17) == {"KEEP": 4} and versions.current(spark, base)[0] == before


def _detail(spark, base):
    compute = lambda df: df.withColumn("n", F.sum("v").over(Window.partitionBy("c")))
    inputs = spark.createDataFrame([(k, k % 5 if k % 7 else None, k) for k in range(40)], "k long, c long, v long")
    H.create_detail(spark, base, compute(inputs).schema, "k", "c", 4)
    H.refresh_detail(base, inputs, "k", "c", [F.asc("v")], compute)
    return inputs, compute


@pytest.mark.parametrize("damage", ["lost", "altered", "added", "signature", "input", "moved", "gone", "none", "twice", "null key"])
def test_refreshed_detail_equals_the_full_result(spark, tmp_path, damage):
    base = f"file://{tmp_path}/d"
    inputs, compute = _detail(spark, base)
    held, state = marked.read(spark, f"{base}/rows"), marked.read(spark, f"{base}/state")
    every = spark.range(4).select(F.col("id").cast("int").alias("bucket"))
    three = F.col("k") == 3
    change = {
        "lost": lambda df: df.filter(~three), "altered": lambda df: df.withColumn("v", F.when(three, 99).otherwise(F.col("v")).cast("long")),
        "added": lambda df: df.unionByName(df.filter(three).withColumn("k", F.lit(77).cast("long"))), "twice": lambda df: df.unionByName(df.filter(three)),
        "null key": lambda df: df.unionByName(df.filter(three).withColumn("k", F.lit(None).cast("long"))),
    }
    if damage in change:
        marked.replace(spark, f"{base}/rows", change[damage](held), every)
    if damage == "signature":
        marked.replace(spark, f"{base}/state", state.withColumn("out_sig", F.when(~three, F.col("out_sig"))), every)
    if damage == "input":
        inputs = inputs.withColumn("v", F.when(three, 50).otherwise(F.col("v")).cast("long"))
    if damage == "moved":
        inputs = inputs.withColumn("c", F.when(~three, F.col("c")))
    if damage == "gone":
        inputs = inputs.filter(~three)
    done = H.refresh_detail(base, inputs, "k", "c", [F.asc("v")], compute)
    assert rows(marked.read(spark, f"{base}/rows").drop("bucket")) == rows(compute(inputs))
    groups = {"none": (0, 0, 0), "lost": (1, 8, 1), "altered": (1, 8, 1), "added": (1, 8, 1), "signature": (1, 8, 0), "input": (1, 8, 8), "moved": (1, 13, 13), "gone": (1, 8, 8)}
    mine = len([k for k in range(40) if k % 5 == 3 and k % 7])
    if damage in groups and damage not in ("moved", "added"):
        want = tuple(mine if x == 8 else x for x in groups[damage])
        assert (done["changed"], done["affected"], done["written"]) == want
    assert H.refresh_detail(base, inputs, "k", "c", [F.asc("v")], compute) == {"changed": 0, "affected": 0, "written": 0}


def test_relations(spark):
    many, one, free = "ONE_TO_MANY", "ONE_TO_ONE", "MANY_TO_MANY"
    edge = [
        ("A", "o1", "i", "t1", "R", None, 1, one), ("A", "o1", "i", "t2", "R", None, 2, one), ("A", "o1", "i", "t2", "R", None, 2, one),
        ("A", "o2", "i", "t3", "R", None, 1, one), ("A", "o2", "i", "t4", "R", None, 1, one), ("A", "o3", "i", "t5", "R", None, 1, one), ("A", "o4", "i", "t5", "R", None, 1, many),
        ("A", "o5", "i", "t6", "R", None, 1, many), ("A", "o5", "i", "t7", "R", None, 1, free), ("A", "o9", "i", "t8", "R", None, 1, many), ("A", "o6", "bad", "t9", "R", None, 1, many),
        ("A", "o6", "i", "zz", "R", None, 1, many), ("A", "o7", "i", "t1", "x", None, 1, many), ("A", "o8", "i", "ta", "R", None, 1, many), ("A", "o8", "i", "tb", "R", None, 1, many),
        ("B", "t2", "j", "u1", "p", None, 1, many), ("B", "t3", "j", "u2", "p", None, 1, many), ("B", "ta", "j", "u3", "q", None, 1, many),
        ("C", "u1", "p", "w", "R", None, 1, free), ("C", "u2", "p", "w", "R", None, 1, free), ("C", "u3", "p", "w", "R", None, 1, free),
    ]
    bindings = spark.createDataFrame(edge, "kind string, origin string, origin_component string, target string, target_component string, target_date date, revision long, cardinality string")
    roots = [("o", f"o{k}") for k in range(1, 9)] + [("t", f"t{k}") for k in "123456789ab"] + [("u", f"u{k}") for k in "123"] + [("w", "w")]
    parts = [("o", f"o{k}", "i") for k in range(1, 9)] + [("t", f"t{k}", "j") for k in "123456789ab"] + [("u", f"u{k}", "p") for k in "123"]
    ends = spark.createDataFrame([("A", "o", "t", "R"), ("B", "t", "u", None), ("C", "u", "w", "R")], "kind string, origin_entity string, target_entity string, root_target string")
    got = R.resolve_relations(bindings, spark.createDataFrame(roots, "entity string, id string"), spark.createDataFrame(parts, "entity string, id string, component string"), ends, [("A", "B"), ("B", "C")])
    found = {(r.origin, r.target, r.revision): r.disposition for r in got.collect()}
    assert len(found) == 20 and got.count() == 20
    assert found == {
        ("o1", "t1", 1): "SUPERSEDED", ("o1", "t2", 2): "RESOLVED", ("o2", "t3", 1): "CONFLICT", ("o2", "t4", 1): "CONFLICT", ("o3", "t5", 1): "CONFLICT", ("o4", "t5", 1): "CONFLICT",
        ("o5", "t6", 1): "CONFLICT", ("o5", "t7", 1): "CONFLICT", ("o9", "t8", 1): "ORIGIN_ABSENT", ("o6", "t9", 1): "COMPONENT_ABSENT", ("o6", "zz", 1): "ORPHAN", ("o7", "t1", 1): "CONFLICT",
        ("o8", "ta", 1): "RESOLVED", ("o8", "tb", 1): "RESOLVED", ("t2", "u1", 1): "RESOLVED", ("t3", "u2", 1): "CHAIN_BLOCKED", ("ta", "u3", 1): "COMPONENT_ABSENT",
        ("u1", "w", 1): "RESOLVED", ("u2", "w", 1): "CHAIN_BLOCKED", ("u3", "w", 1): "CHAIN_BLOCKED",
    }
