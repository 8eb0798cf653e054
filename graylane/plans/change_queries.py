"""Queries that prove change capture on the supplied tables; the second version of a table is a fixed alteration of it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from graylane import storage
from graylane.operators import changes as H
from graylane.operators import windows as W
from graylane.registry import query
from graylane.sources import marked

_INCOMING = """i AS (SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN d + INTERVAL 1 DAY WHEN 1 THEN d - INTERVAL 1 DAY WHEN 2 THEN NULL ELSE d END AS f, CASE WHEN o_orderkey % 7 IN (0, 1, 2, 3) THEN o_orderstatus || 'x' ELSE o_orderstatus END AS c
 FROM (SELECT *, o_orderdate AS d FROM orders) WHERE o_orderkey % 11 != 0), o AS (SELECT o_orderkey AS k, o_orderdate AS f, o_orderstatus AS c FROM orders WHERE o_orderkey % 13 != 0),
d AS (SELECT coalesce(i.k, o.k) AS k, o.f AS old_f, o.c AS old_c, i.f AS new_f, i.c AS new_c, CASE WHEN i.k IS NULL THEN 'KEEP' WHEN o.k IS NULL THEN 'INSERT' WHEN o.f IS NOT DISTINCT FROM i.f AND o.c IS NOT DISTINCT FROM i.c THEN 'REPLAY' WHEN o.f IS NULL OR i.f IS NULL THEN 'NULL_FRESHNESS'
 WHEN i.f < o.f THEN 'STALE' WHEN i.f = o.f THEN 'CONFLICT' ELSE 'UPDATE' END AS decision FROM i FULL JOIN o USING (k))"""


def _versions(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("f"), F.col("o_orderstatus").alias("c"))
    r = F.col("k") % 7
    day = F.expr("make_dt_interval(1)")
    fresh = F.when(r == 0, F.col("f") + day).when(r == 1, F.col("f") - day).when(r == 2, F.lit(None)).otherwise(F.col("f"))
    incoming = o.filter("k % 11 != 0").select("k", fresh.alias("f"), F.when(r <= 3, F.concat("c", F.lit("x"))).otherwise(F.col("c")).alias("c"))
    return o.filter("k % 13 != 0"), incoming


@query(f"WITH {_INCOMING} SELECT k, decision FROM d")
def promotion_decision(t):
    return H.decide(*_versions(t), "k", "f", "c").select("k", "decision")


@query(f"WITH {_INCOMING} SELECT k, CASE WHEN decision IN ('INSERT', 'UPDATE') THEN new_f ELSE old_f END AS f, CASE WHEN decision IN ('INSERT', 'UPDATE') THEN new_c ELSE old_c END AS c FROM d")
def apply_changes(t):
    return H.apply_changes(*_versions(t), "k", "f", "c").select("k", "f", "c")


@query(f"WITH {_INCOMING} SELECT decision, count(*) AS n FROM d GROUP BY 1")
def apply_receipt(t):
    return H.receipt(H.decide(*_versions(t), "k", "f", "c"))


@query(f"WITH {_INCOMING} SELECT k, decision AS action, old_c AS old_value, new_c AS new_value FROM d WHERE decision IN ('INSERT', 'UPDATE')")
def change_history(t):
    return H.history(H.decide(*_versions(t), "k", "f", "c"), "k", "c")


@query("SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def change_lineage(t):
    return H.lineage(t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")), "o_custkey", "l_suppkey")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 1 ELSE 5 END AS f, CASE WHEN c_custkey % 4 = 1 THEN NULL WHEN c_custkey % 4 = 2 THEN 'NEW' ELSE c_mktsegment END AS seg, c_custkey % 4 != 3 AS applied
FROM (SELECT c_custkey, c_mktsegment FROM customer)""")
def patch_merge(t):
    c = t("customer").select("c_custkey", F.lit(1).alias("f"), F.col("c_mktsegment").alias("seg"))
    r = F.col("c_custkey") % 4
    n = c.select("c_custkey", F.when(r == 3, 0).otherwise(5).alias("f"), F.lit("NEW").alias("seg"), F.when(r == 0, "ABSENT").when(r == 1, "NULL").otherwise("VALUE").alias("seg_presence"))
    return H.patch(c, n, "c_custkey", "f", ["seg"])


@query("""WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d FROM events), x AS (SELECT *, d = max(d) OVER (PARTITION BY user_id) AS top FROM e), y AS (SELECT *, min(event_type) OVER w != max(event_type) OVER w AS mixed, min(event_id) OVER w AS first FROM x WINDOW w AS (PARTITION BY user_id, top))
SELECT event_id, CASE WHEN NOT top THEN 'STALE' WHEN mixed THEN 'QUARANTINE' WHEN event_id != first THEN 'DUPLICATE' ELSE 'ACCEPT' END AS disposition FROM y""")
def screen_batch(t):
    e = t("events").withColumn("d", F.to_date("ts"))
    return H.screen_batch(e, ["user_id"], "d", "event_type", "event_id").select("event_id", "disposition")


@query("""WITH v AS (SELECT *, event_type != 'error' AS a, value > 20 AS fl, lag(event_type != 'error') OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events)
SELECT event_id, CASE WHEN b IS NULL THEN 'FIRST' WHEN NOT b AND a AND fl THEN 'REACTIVATED' WHEN NOT b AND a THEN 'REFUSED' WHEN b AND NOT a THEN 'DEACTIVATED' ELSE 'UNCHANGED' END AS effect FROM v""")
def reactivation(t):
    return H.reactivation(t("events"), ["user_id"], "event_id", F.col("event_type") != "error", F.col("value") > 20).select("event_id", "effect")


@query("""WITH l AS (SELECT * FROM events WHERE event_type != 'signup' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1), q AS (SELECT user_id, max(ts) AS q FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT l.user_id, event_id FROM l LEFT JOIN q USING (user_id) WHERE event_type != 'error' AND (q IS NULL OR q <= ts)""")
def current_view(t):
    e = t("events")
    return H.current_view(e.filter("event_type != 'signup'"), ["user_id"], [F.desc("ts"), F.desc("event_id")], F.col("event_type") != "error", e.filter("event_type = 'signup'"), "ts").select("user_id", "event_id")


@query("""WITH s AS (SELECT user_id, event_id FROM events WHERE event_id % 10 < 8 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
n AS (SELECT user_id, event_id FROM events WHERE user_id % 17 != 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1), t AS (SELECT DISTINCT user_id FROM events WHERE event_id % 10 >= 8 OR user_id % 17 = 0)
SELECT coalesce(s.user_id, n.user_id) AS user_id, CASE WHEN n.event_id IS NOT NULL AND coalesce(s.user_id, n.user_id) IN (SELECT user_id FROM t) THEN n.event_id ELSE s.event_id END AS event_id, NOT (n.event_id IS NULL AND coalesce(s.user_id, n.user_id) IN (SELECT user_id FROM t)) AS active FROM s FULL JOIN n USING (user_id)""")
def refresh_winners(t):
    """Winners after later rows arrived and some keys lost all rows; only touched keys are recomputed."""
    e, order = t("events").select("user_id", "event_id", "ts"), [F.desc("ts"), F.desc("event_id")]
    state = W.latest_per_key(e.filter("event_id % 10 < 8"), ["user_id"], order).select("user_id", "event_id").withColumn("active", F.lit(True))
    return H.refresh_winners(state, e.filter("user_id % 17 != 0"), e.filter("event_id % 10 >= 8 or user_id % 17 = 0"), ["user_id"], order).select("user_id", "event_id", "active")


@query("""WITH a AS (SELECT l_orderkey AS k, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1), o AS (SELECT k, n, CASE WHEN k % 9 = 0 THEN q + 1 ELSE q END AS q FROM a WHERE k % 10 != 0), i AS (SELECT * FROM a WHERE k % 14 != 0)
SELECT coalesce(i.k, o.k) AS k, CASE WHEN o.k IS NULL THEN 'NEW' WHEN i.k IS NULL THEN 'GONE' ELSE 'CHANGED' END AS change FROM i FULL JOIN o USING (k) WHERE o.k IS NULL OR i.k IS NULL OR o.q != i.q""")
def incremental_detail(t):
    a = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    sig = F.sha2(F.concat_ws("|", "n", "q"), 256).alias("sig")
    state = a.filter("k % 10 != 0").withColumn("q", F.when(F.col("k") % 9 == 0, F.col("q") + 1).otherwise(F.col("q"))).select("k", sig)
    return H.incremental_detail(a.filter("k % 14 != 0").select("k", sig), state, "k", "sig")


@query("""WITH c AS (SELECT CAST(ts AS DATE) AS day, max(event_id) AS run FROM events GROUP BY 1), a AS (SELECT day, CASE WHEN day(day) % 3 = 0 THEN run - 1 ELSE run END AS run FROM c WHERE day(day) % 5 != 0 UNION ALL SELECT DATE '2023-12-31', 1)
SELECT coalesce(c.day, a.day) AS day, c.run AS run FROM c FULL JOIN a ON c.day = a.day WHERE c.run IS DISTINCT FROM a.run""")
def pending_partitions(t):
    c = t("events").groupBy(F.to_date("ts").alias("day")).agg(F.max("event_id").alias("run"))
    a = c.filter(F.dayofmonth("day") % 5 != 0).withColumn("run", F.when(F.dayofmonth("day") % 3 == 0, F.col("run") - 1).otherwise(F.col("run")))
    a = a.unionByName(c.limit(1).select(F.lit("2023-12-31").cast("date").alias("day"), F.lit(1).cast("long").alias("run")))
    return H.pending_partitions(c, a, ["day"], "run")


@query("""WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type AS scope, CAST(value AS DECIMAL(18,2)) AS v FROM events), k AS (SELECT DISTINCT day, scope FROM e WHERE day(day) != 7)
SELECT k.day, k.scope, coalesce(sum(CASE WHEN day(k.day) % 2 = 0 THEN v ELSE 0 END), 0) AS total, count(v) AS n, CAST(CASE WHEN day(k.day) % 2 = 0 OR day(k.day) = 9 THEN 2 ELSE 1 END AS BIGINT) AS run
FROM k LEFT JOIN e ON e.day = k.day AND e.scope = k.scope AND day(k.day) != 9 GROUP BY 1, 2""")
def replace_partitions(t):
    """By day and scope: even days come from the second run, the 9th has a second run without rows, the 7th is covered no more, the others stay as first published (with amount 0); the marks say which run each has."""
    e = t("events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("scope"), F.col("value").cast("decimal(18,2)").alias("v"))
    base, spark, parts = storage.new_path(e.sparkSession, "published-days"), e.sparkSession, ["day", "scope"]
    marked.create(spark, base, e.schema, parts, StructType([StructField("run", LongType())]))
    rows = e.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows"))
    first = e.select(*parts, F.lit(1).cast("long").alias("run")).distinct()
    H.replace_partitions(base, e.withColumn("v", F.lit(0).cast("decimal(18,2)")), first, "run", rows)
    second = first.filter(F.dayofmonth("day") != 7).withColumn("run", F.when((F.dayofmonth("day") % 2 == 0) | (F.dayofmonth("day") == 9), F.lit(2)).otherwise(F.col("run")).cast("long"))
    H.replace_partitions(base, e.filter(F.dayofmonth("day") != 9), second, "run", rows.filter(F.dayofmonth("day") != 9))
    found = marked.read(spark, base).groupBy(*parts).agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
    return marked.marks(spark, base).drop("token").join(found, parts, "left").select(*parts, "run", F.coalesce("total", F.lit(0)).cast("decimal(28,2)").alias("total"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("""WITH i AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 70 = 9 THEN NULL WHEN o_orderkey % 80 = 11 THEN o_custkey + 1 ELSE o_custkey END AS c, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 50 = 3 THEN 10 ELSE 0 END AS v FROM orders WHERE o_orderkey % 40 != 7) SELECT k, c, v, sum(v) OVER (PARTITION BY c) AS shared_total FROM i""")
def refresh_detail(t):
    """After changes, removals, moves to another secondary key, and damage to what was published (rows lost, altered and added, signatures lost) the incremental result is the one of a full computation."""
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 70 != 9, F.col("o_custkey")).alias("c"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    spark, base = o.sparkSession, storage.new_path(o.sparkSession, "detail")
    compute = lambda df: df.withColumn("shared_total", F.sum("v").over(Window.partitionBy("c")))
    H.create_detail(spark, base, compute(o).schema, "k", "c", 8)
    H.refresh_detail(base, o.filter("k % 45 != 4"), "k", "c", [F.asc("v")], compute)
    every = spark.range(8).select(F.col("id").cast("int").alias("bucket"))
    rows, state = storage.written(marked.read(spark, f"{base}/rows"), "detail-rows"), storage.written(marked.read(spark, f"{base}/state"), "detail-state")
    odd = rows.filter("k % 60 = 5").withColumn("k", -F.col("k"))
    marked.replace(spark, f"{base}/rows", rows.filter("k % 60 != 5").withColumn("v", F.when(F.col("k") % 60 == 6, 0).otherwise(F.col("v")).cast("decimal(18,2)")).unionByName(odd), every)
    marked.replace(spark, f"{base}/state", state.withColumn("out_sig", F.when(F.col("k") % 60 != 7, F.col("out_sig"))), every)
    new = o.filter("k % 40 != 7").withColumn("v", (F.col("v") + F.when(F.col("k") % 50 == 3, 10).otherwise(0)).cast("decimal(18,2)")).withColumn("c", F.when((F.col("k") % 80 == 11) & F.col("c").isNotNull(), F.col("c") + 1).otherwise(F.col("c")))
    H.refresh_detail(base, new, "k", "c", [F.asc("v")], compute)
    return marked.read(spark, f"{base}/rows").drop("bucket")


@query(f"WITH {_INCOMING} SELECT count(*) FILTER (decision = 'INSERT') AS inserts, count(*) FILTER (decision = 'UPDATE') AS updates, count(*) FILTER (decision IN ('REPLAY', 'KEEP')) AS noops, count(*) FILTER (decision IN ('STALE', 'CONFLICT', 'NULL_FRESHNESS')) AS blocked, count(*) AS candidates, 'MISMATCH' AS status FROM d")
def materialize_receipt(t):
    d = H.decide(*_versions(t), "k", "f", "c")
    stored = d.sparkSession.createDataFrame([("r1", 1, 2, 3, 4)], "receipt string, inserts long, updates long, noops long, blocked long")
    return H.materialize_receipt(d, stored, "r1")


@query("""SELECT c_custkey, CAST(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') THEN 0 ELSE least(coalesce(CASE WHEN c_custkey % 4 != 3 THEN c_custkey % 4 END, 0) + 1, 2) END AS INTEGER) AS confirmations,
CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') THEN CASE WHEN c_custkey % 4 = 2 THEN 'REACTIVATED' ELSE 'PRESENT' END WHEN c_custkey % 4 IN (1, 2) THEN 'EXCLUDED' ELSE 'SUSPECT' END AS status FROM customer""")
def absence_sweep(t):
    c = t("customer").select("c_custkey")
    seen = t("orders").filter("o_orderdate >= timestamp_ntz'2001-01-01 00:00:00'").select(F.col("o_custkey").alias("c_custkey"))
    state = c.filter("c_custkey % 4 != 3").select("c_custkey", (F.col("c_custkey") % 4).cast("int").alias("confirmations"))
    return H.absence_sweep(c, seen, state, "c_custkey")


# months as sweeps: some incomplete, some not eligible, some with the capture of the month before, one of another scope
_SWEEPS = """s AS (SELECT DISTINCT year(o_orderdate) * 12 + month(o_orderdate) AS sweep FROM orders), w AS (SELECT sweep, sweep // 4 * 4 + CASE WHEN sweep % 4 = 3 THEN 2 ELSE sweep % 4 END AS capture FROM s WHERE sweep % 5 != 0 AND sweep % 7 != 0 AND sweep % 13 != 1),
v AS (SELECT sweep, row_number() OVER (ORDER BY sweep) AS n FROM w WHERE sweep = (SELECT min(x.sweep) FROM (SELECT sweep, sweep // 4 * 4 + CASE WHEN sweep % 4 = 3 THEN 2 ELSE sweep % 4 END AS capture FROM s) x WHERE x.capture = w.capture)),
g AS (SELECT c_custkey, v.sweep, n, EXISTS (FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) * 12 + month(o_orderdate) = v.sweep) AS seen FROM customer, v),
k AS (SELECT *, n - coalesce(max(CASE WHEN seen THEN n END) OVER (PARTITION BY c_custkey ORDER BY n), 0) AS gap FROM g), b AS (SELECT *, least(gap, 2) AS after, coalesce(lag(least(gap, 2)) OVER (PARTITION BY c_custkey ORDER BY n), 0) AS before FROM k)"""


def _sweeps(t):
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long")
    sweep = F.col("sweep")
    s = t("orders").select(month.alias("sweep")).distinct()
    s = s.select("sweep", sweep.alias("at"), F.expr("sweep div 4 * 4 + if(sweep % 4 = 3, 2, sweep % 4)").alias("capture"), F.when(sweep % 13 == 1, "part").otherwise("all").alias("scope"), (sweep % 5 != 0).alias("complete"), F.when(sweep % 7 != 0, True).alias("eligible"))
    return H.absence_history(t("customer").select("c_custkey"), t("orders").select(month.alias("sweep"), F.col("o_custkey").alias("c_custkey")), s, "c_custkey")


@query(f"WITH {_SWEEPS} SELECT c_custkey, sweep, before, after, CASE WHEN after = 1 THEN 'SUSPECT' WHEN after = 2 THEN 'EXCLUDED' ELSE 'REACTIVATED' END AS status FROM b WHERE before != after")
def absence_history(t):
    """Only complete, eligible sweeps of one scope with a capture of their own count."""
    return _sweeps(t)[0]


@query(f"WITH {_SWEEPS} SELECT c_custkey, arg_max(after, n) AS confirmations, CASE WHEN arg_max(gap, n) > 0 THEN arg_max((SELECT sweep FROM v WHERE v.n = b.n - b.gap + 1), n) END AS first_absent FROM b GROUP BY 1")
def absence_state(t):
    return _sweeps(t)[1]


@query("""WITH e AS (SELECT event_id, user_id, event_id % 20 AS root, event_type, CAST(ts AS DATE) AS d, CASE WHEN event_id % 20 = 3 AND event_id % 3 = 0 THEN 'USD' WHEN event_id % 20 = 4 AND event_id % 3 = 0 THEN NULL ELSE 'BRL' END AS unit FROM events), x AS (SELECT *, d = max(d) OVER (PARTITION BY root, user_id) AS top FROM e),
y AS (SELECT *, min(event_type) OVER w != max(event_type) OVER w AS mixed, min(event_id) OVER w AS first FROM x WINDOW w AS (PARTITION BY root, user_id, top))
SELECT event_id, CASE WHEN NOT top THEN 'STALE' WHEN mixed THEN 'QUARANTINE' WHEN event_id != first THEN 'DUPLICATE' WHEN root = 5 OR EXISTS (FROM e o WHERE o.root = y.root AND o.unit != y.unit) THEN 'QUARANTINE_UNIT' ELSE 'ACCEPT' END AS disposition FROM y""")
def screen_units(t):
    """Root 3 has two currencies, root 4 one and nulls, root 5 another one than it has stored."""
    e = t("events").withColumns({"d": F.to_date("ts"), "root": F.col("event_id") % 20})
    third = F.col("event_id") % 3 == 0
    e = e.withColumn("unit", F.when((F.col("root") == 3) & third, "USD").when((F.col("root") == 4) & third, None).otherwise("BRL"))
    stored = e.select("root", F.when(F.col("root") == 5, "EUR").when(F.col("root") % 2 == 0, "BRL").alias("unit")).distinct().filter("root != 4 or unit is not null")
    return H.screen_batch(e, ["root", "user_id"], "d", "event_type", "event_id", ["root"], ["unit"], stored).select("event_id", "disposition")


@query("""WITH a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 != 0 THEN o_orderdate END AS own, o_orderstatus AS st, o_custkey % 11 AS run FROM orders), r AS (SELECT l_orderkey AS k, CASE WHEN l_orderkey % 4 = 1 THEN NULL WHEN l_orderkey % 4 = 2 THEN o_orderdate ELSE l_shipdate END AS other, l_linestatus AS st, l_suppkey % 11 AS run, l_partkey % 10 AS version FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber = 2),
j AS (SELECT a.k, own, other, a.st, r.st AS rst, a.run, r.run AS rrun, version, r.k IS NOT NULL AS there FROM a LEFT JOIN r ON r.k = a.k)
SELECT k, CASE WHEN there AND run = rrun THEN 'EXECUTION_MISMATCH' WHEN k % 17 = 0 THEN 'WINDOW_MISMATCH' WHEN NOT there THEN CASE WHEN own IS NULL THEN 'REFERENCE_ABSENT' ELSE 'RETAINED' END WHEN version = 0 THEN 'CONTRACT_MISMATCH' WHEN st != rst AND st != 'P' THEN 'STATUS_MISMATCH'
 WHEN other IS NULL THEN CASE WHEN own IS NULL THEN 'REFERENCE_INVALID' ELSE 'RETAINED' END WHEN own IS NOT NULL AND own != other THEN 'SOURCE_TIME_CONFLICT' WHEN own IS NULL THEN 'COMPLEMENTED' ELSE 'RETAINED' END AS outcome FROM j""")
def link_checked(t):
    a = t("orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("own"), F.col("o_orderstatus").alias("st"), (F.col("o_custkey") % 11).alias("run"), "o_orderdate")
    k, line = F.col("l_orderkey"), t("lineitem").filter("l_linenumber = 2").select("l_orderkey", "l_shipdate", F.col("l_linestatus").alias("rst"), (F.col("l_suppkey") % 11).alias("rrun"), (F.col("l_partkey") % 10).alias("version"))
    pairs = a.join(line, a["k"] == line["l_orderkey"], "left").withColumn("other", F.when(k % 4 == 1, None).when(k % 4 == 2, F.col("o_orderdate")).otherwise(F.col("l_shipdate")))
    before = [("EXECUTION_MISMATCH", F.col("run") == F.col("rrun")), ("WINDOW_MISMATCH", F.col("k") % 17 == 0)]
    after = [("CONTRACT_MISMATCH", F.col("version") == 0), ("STATUS_MISMATCH", (F.col("st") != F.col("rst")) & (F.col("st") != "P"))]
    return H.link_checked(pairs, "own", "other", k.isNotNull(), before, after).select("k", "outcome")


@query("""SELECT c_custkey, CASE WHEN a > 1 OR b > 1 THEN 'QUARANTINE' WHEN a = 0 AND b = 0 THEN 'NEW' WHEN a = 1 AND b = 1 AND i = 1 THEN 'REACTIVATE' WHEN a = 1 AND b = 1 THEN 'REPLAY' WHEN a = 1 THEN 'VERSION' ELSE 'ALIAS' END AS identity
FROM (SELECT c_custkey, c_custkey % 3 AS a, c_custkey // 3 % 3 AS b, c_custkey % 2 AS i FROM customer)""")
def identity_decision(t):
    c = t("customer").select("c_custkey", (F.col("c_custkey") % 3).alias("same_key"), F.expr("c_custkey div 3 % 3").alias("same_content"), (F.col("c_custkey") % 2).alias("inactive"))
    return H.identity_decision(c).select("c_custkey", "identity")


@query("""WITH b AS (SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1), a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 != 0 THEN o_orderdate END AS d FROM orders)
SELECT o_orderkey, CASE WHEN lo != hi THEN 'CONFLICT' WHEN d IS NULL AND lo IS NOT NULL THEN 'COMPLEMENTED' WHEN d IS NULL THEN 'ABSENT' ELSE 'RETAINED' END AS outcome, CASE WHEN lo = hi AND d IS NULL THEN lo ELSE d END AS d FROM a LEFT JOIN b ON l_orderkey = o_orderkey""")
def link_reference(t):
    a = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("d"))
    b = t("lineitem").filter("l_linenumber <= 2").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return H.link_reference(a, b, "o_orderkey", "d", "l_shipdate").select("o_orderkey", "outcome", "d")


@query("SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey % 100 = 1)")
def days_to_recapture(t):
    index = t("lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("day"))
    return H.days_to_recapture(t("orders").filter("o_custkey % 100 = 1").select(F.col("o_orderkey").alias("l_orderkey")), index, "l_orderkey", "day")


@query("""SELECT DISTINCT part FROM (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS part FROM orders WHERE o_orderkey % 97 = 0 UNION ALL SELECT year(o_orderdate + INTERVAL 40 DAY) * 100 + month(o_orderdate + INTERVAL 40 DAY) FROM orders WHERE o_orderkey % 97 = 0)""")
def affected_partitions(t):
    month = lambda c: (F.year(c) * 100 + F.month(c)).cast("long").alias("part")
    o = t("orders")
    return H.affected_partitions(o.filter("o_orderkey % 97 = 0").select("o_orderkey", month(F.col("o_orderdate") + F.expr("make_dt_interval(40)"))), o.select("o_orderkey", month(F.col("o_orderdate"))), "o_orderkey", "part")


@query("""WITH l AS (SELECT user_id, event_type FROM events QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1)
SELECT user_id, CASE WHEN count(DISTINCT event_type) = 1 THEN 'READY' ELSE 'CONFLICT' END AS state, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) END AS value FROM l GROUP BY 1""")
def latest_terms(t):
    """One variant at the latest revision is ready, several are a conflict."""
    top = W.top_cohort(t("events"), ["user_id"], [F.to_date("ts").desc()])
    one = F.min("event_type") == F.max("event_type")
    return top.groupBy("user_id").agg(F.when(one, "READY").otherwise("CONFLICT").alias("state"), F.when(one, F.min("event_type")).alias("value"))


@query("""WITH s AS (SELECT event_id, event_type AS b, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a FROM events)
SELECT event_id, a AS from_state, b AS to_state FROM s WHERE a IS NOT NULL AND (a, b) NOT IN (VALUES ('view', 'click'), ('click', 'purchase'), ('signup', 'view'), ('view', 'view'))""")
def illegal_transitions(t):
    e = t("events")
    allowed = e.sparkSession.createDataFrame([("view", "click"), ("click", "purchase"), ("signup", "view"), ("view", "view")], "from_state string, to_state string")
    return H.illegal_transitions(e, ["user_id"], [F.asc("ts"), F.asc("event_id")], "event_type", allowed).select("event_id", "from_state", "to_state")
