"""Queries that prove windows, limits, aggregates and set operations on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graylane.operators import aggregates as A
from graylane.operators import sets
from graylane.operators import windows as W
from graylane.registry import query


@query("SELECT * FROM (SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)")
def latest_per_key(t):
    return W.latest_per_key(t("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey DESC) = 1")
def latest_ranked_case(t):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return W.latest_per_key(t("orders"), ["o_custkey"], [rank, F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word, unnest(range(len(string_split(text, ' ')))) AS pos FROM documents)
SELECT doc_id, word, CAST(max(pos) AS INTEGER) AS pos FROM w GROUP BY 1, 2""")
def last_wins(t):
    """Of a repeated word of a text, the last place."""
    w = t("documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    return W.latest_per_key(w, ["doc_id", "word"], [F.desc("pos")]).select("doc_id", "word", "pos")


@query("""SELECT o_custkey, count(*) AS kept FROM (SELECT *, max(o_orderdate) FILTER (o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE m IS NULL OR o_orderdate >= m GROUP BY 1""")
def drop_superseded(t):
    kept = W.drop_superseded(t("orders"), ["o_custkey"], F.col("o_orderdate"), F.col("o_orderstatus") == "F")
    return kept.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("kept"))


@query("SELECT user_id, event_id FROM events QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1")
def top_cohort(t):
    return W.top_cohort(t("events"), ["user_id"], [F.to_date("ts").desc()]).select("user_id", "event_id")


@query("SELECT user_id, count(*) AS ties FROM (SELECT user_id FROM events QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_type) = 1) GROUP BY 1 HAVING count(*) > 1")
def ambiguous_winners(t):
    return W.ambiguous_winners(t("events"), ["user_id"], [F.to_date("ts").desc(), F.col("event_type")])


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, sum(v) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING) AS running, sum(v) OVER (PARTITION BY l_orderkey) AS total,
max(v) OVER (PARTITION BY l_orderkey) AS most, count(*) OVER (PARTITION BY l_orderkey) AS rows, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place FROM l""")
def running_sum(t):
    l = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))  # noqa: E741
    return W.running(l, ["l_orderkey"], [F.asc("l_linenumber")], F.col("v")).drop("v")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 9 = 0 THEN 0 ELSE CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) END AS w FROM lineitem GROUP BY 1, 2),
j AS (SELECT l_orderkey, l_linenumber, o_totalprice AS total, CASE WHEN sum(w) OVER (PARTITION BY l_orderkey) = 0 THEN 1 ELSE w END AS w FROM l JOIN orders ON o_orderkey = l_orderkey),
c AS (SELECT *, CAST(round(CAST(total AS DECIMAL(18,2)) * 100) AS HUGEINT) AS t, CAST(round(w * 10000) AS HUGEINT) AS v FROM (SELECT l_orderkey, l_linenumber, total, CASE WHEN l_orderkey % 9 = 0 THEN 0.0001 ELSE w END AS w FROM j)),
u AS (SELECT *, CAST(sum(v) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS HUGEINT) AS u, CAST(sum(v) OVER (PARTITION BY l_orderkey) AS HUGEINT) AS s FROM c)
SELECT l_orderkey, l_linenumber, CAST(((2 * t * u + s) // (2 * s) - (2 * t * (u - v) + s) // (2 * s)) / 100 AS DECIMAL(18,2)) AS share FROM u""")
def allocate(t):
    """An order's price dealt over its lines by quantity; every ninth order has no weights."""
    q = F.sum(F.col("l_quantity").cast("decimal(18,4)")).cast("decimal(18,4)")
    l = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(q.alias("q"))  # noqa: E741
    j = l.join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    weight = F.when(F.col("l_orderkey") % 9 == 0, F.lit(0).cast("decimal(18,4)")).otherwise(F.col("q"))
    return W.allocate(j, ["l_orderkey"], F.col("o_totalprice"), weight, [F.asc("l_linenumber")]).select("l_orderkey", "l_linenumber", "share")


@query("""WITH d AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2),
g AS (SELECT *, coalesce(date_diff('day', lag(day) OVER (PARTITION BY p ORDER BY day), day) - 1, 0) AS gap FROM d),
b AS (SELECT p, CAST(sum(gap) AS BIGINT) AS gaps, min(CASE WHEN gap > 0 THEN day - CAST(gap AS INTEGER) WHEN n < 2 THEN day END) AS bad, max(day) AS last, min(day) AS start FROM g GROUP BY 1)
SELECT p AS o_orderpriority, gaps, CASE WHEN coalesce(bad - 1, last) >= start THEN CAST(coalesce(bad - 1, last) AS DATE) END AS frontier FROM b""")
def frontier(t):
    days = t("orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return W.frontier(days, ["o_orderpriority"], "day", F.col("n") >= 2)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_totalprice > 450000 ORDER BY o_orderkey")
def bounded_read(t):
    return W.bounded(t("orders").filter("o_totalprice > 450000").select("o_orderkey", "o_orderdate"), [F.asc("o_orderkey")], 5_000_000)


@query("SELECT o_orderdate, o_orderkey FROM orders WHERE (o_orderdate, o_orderkey) < (SELECT (max(o_orderdate), 0) FROM orders) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def keyset_page(t):
    o = t("orders").select("o_orderdate", "o_orderkey")
    last = o.agg(F.max("o_orderdate")).first()[0]
    return W.page_after(o, ["o_orderdate", "o_orderkey"], [F.lit(last).cast("timestamp_ntz"), F.lit(0).cast("long")], 50)


@query("SELECT event_id, ts FROM events WHERE event_type = 'error' AND event_id % 5 < 3 ORDER BY ts, event_id LIMIT 20")
def next_batch(t):
    return W.next_batch(t("events").select("event_id", "ts", "event_type"), (F.col("event_type") == "error") & (F.col("event_id") % 5 < 3), [F.asc("ts"), F.asc("event_id")], 20).select("event_id", "ts")


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, sum(CAST(value AS DECIMAL(18,2))) AS total, min(ts) AS first_ts, max(ts) AS last_ts, CASE WHEN count(DISTINCT CAST(ts AS DATE)) >= 30 THEN 'COMPLETE' ELSE 'PARTIAL' END AS status FROM events GROUP BY 1""")
def coverage_overview(t):
    return A.overview(t("events"), ["event_type"], {"users": F.col("user_id"), "days": F.to_date("ts")}, {"total": F.col("value").cast("decimal(18,2)")}, "ts", ("days", 30)).drop("days")


@query("""SELECT k, CAST(sum(a) AS BIGINT) AS views, CAST(sum(b) AS BIGINT) AS purchases, CAST(sum(c) AS BIGINT) AS orders, CASE WHEN sum(a) > 0 THEN CAST(sum(b) AS DOUBLE) / sum(a) END AS ratio FROM (
SELECT user_id AS k, 1 AS a, 0 AS b, 0 AS c FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, 0, 1, 0 FROM events WHERE event_type = 'purchase' UNION ALL SELECT o_custkey, 0, 0, 1 FROM orders) GROUP BY k""")
def contributions(t):
    e, o = t("events"), t("orders")
    parts = {"views": e.filter("event_type = 'view'").select(F.col("user_id").alias("k")), "purchases": e.filter("event_type = 'purchase'").select(F.col("user_id").alias("k")), "orders": o.select(F.col("o_custkey").alias("k"))}
    return A.contributions(parts, ["k"]).withColumn("ratio", A.ratio(F.col("purchases"), F.col("views")))


@query("SELECT upper(trim(p_name)) AS name, max(p_brand) AS brand, max(p_type) AS kind FROM part GROUP BY 1")
def dimension(t):
    return A.dimension(t("part"), F.concat(F.lit(" "), F.col("p_name")), {"brand": F.col("p_brand"), "kind": F.col("p_type")})


@query("""SELECT l_orderkey, CASE WHEN min(l_returnflag) FILTER (l_linestatus = 'O') IS NULL THEN 'NULL' WHEN min(l_returnflag) FILTER (l_linestatus = 'O') = max(l_returnflag) FILTER (l_linestatus = 'O') THEN 'VALUE' ELSE 'CONFLICT' END AS state,
CASE WHEN min(l_returnflag) FILTER (l_linestatus = 'O') = max(l_returnflag) FILTER (l_linestatus = 'O') THEN min(l_returnflag) FILTER (l_linestatus = 'O') END AS value FROM lineitem GROUP BY 1""")
def consensus(t):
    return A.consensus(t("lineitem"), ["l_orderkey"], "l_returnflag", F.col("l_linestatus") == "O")


@query("""WITH c AS (SELECT user_id, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2 END AS flag FROM events QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1)
SELECT user_id, count(*) AS cohort, CASE min(CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END) WHEN 0 THEN 'error' WHEN 1 THEN 'purchase' WHEN 2 THEN 'view' ELSE 'UNKNOWN' END AS event_type,
CASE WHEN min(flag) IS NULL THEN 'NULL' WHEN min(flag) = max(flag) AND count(*) = count(flag) THEN 'VALUE' ELSE 'CONFLICT' END AS flag_state, CASE WHEN min(flag) = max(flag) AND count(*) = count(flag) THEN min(flag) END AS flag FROM c GROUP BY 1""")
def reduce_cohort(t):
    df = t("events").withColumn("flag", F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 2))
    return A.reduce_cohort(df, ["user_id"], [F.to_date("ts").desc()], ["flag"], "event_type", ["error", "purchase", "view"])


_COHORT = """WITH l AS (SELECT l_orderkey % (SELECT count(*) FROM orders) // 8 AS k, l_shipdate, l_returnflag AS st, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_orderkey % 3 END AS f, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_orderkey % 2 END AS m,
CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_suppkey % 4 END AS child, l_linenumber % 2 AS attr FROM lineitem), c AS (SELECT * FROM l QUALIFY dense_rank() OVER (PARTITION BY k ORDER BY year(l_shipdate) DESC) = 1),
h AS (SELECT k, child, count(*) AS copies, min(attr) AS attr, min(attr) != max(attr) AS off FROM c WHERE child IS NOT NULL GROUP BY 1, 2)"""


def _cohort(t):
    l, n = t("lineitem"), t("orders").count()  # noqa: E741
    rows = l.select(
        F.floor(F.col("l_orderkey") % n / 8).cast("long").alias("k"), F.col("l_shipdate"), F.col("l_returnflag").alias("st"), F.when(F.col("l_linenumber") % 5 != 0, F.col("l_orderkey") % 3).alias("f"), F.when(F.col("l_linenumber") % 2 != 0, F.col("l_orderkey") % 2).alias("m"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_suppkey") % 4).alias("child"), (F.col("l_linenumber") % 2).cast("long").alias("attr"),
    )
    return A.reduce_nested(rows, ["k"], [F.year("l_shipdate").desc()], ["f"], ["m"], "st", ["R", "A"], "child", ["attr"])


@query(f"""{_COHORT}, s AS (SELECT k, CASE WHEN count(f) = 0 THEN 'NULL' WHEN count(DISTINCT f) > 1 OR count(f) < count(*) THEN 'CONFLICT' ELSE 'VALUE' END AS f_state, min(f) AS f, CASE WHEN count(m) = 0 THEN 'NULL' WHEN count(DISTINCT m) > 1 THEN 'CONFLICT' ELSE 'VALUE' END AS m_state, min(m) AS m,
CASE WHEN bool_or(st = 'N') AND bool_or(st != 'N') THEN 'CONFLICT' ELSE 'VALUE' END AS st_state, CASE WHEN bool_or(st = 'R') THEN 'R' WHEN bool_or(st = 'A') THEN 'A' ELSE min(st) END AS st, count(*) AS cohort FROM c GROUP BY k),
n AS (SELECT k, count(*) FILTER (NOT off) AS children, count(*) FILTER (off) AS quarantined FROM h GROUP BY k)
SELECT s.k, cohort, f_state, CASE f_state WHEN 'VALUE' THEN f END AS f, m_state, CASE m_state WHEN 'VALUE' THEN m END AS m, st_state, CASE st_state WHEN 'VALUE' THEN st END AS st, coalesce(children, 0) AS children, coalesce(quarantined, 0) AS quarantined, 'CONFLICT' IN (f_state, m_state, st_state) AS conflict FROM s LEFT JOIN n ON n.k = s.k""")
def reduce_nested(t):
    """Groups of eight orders by the lines of their last year: a field, a metric that nulls complement, a status with a code that the precedence doesn't know, children by supplier."""
    return _cohort(t)[0]


@query(f"""{_COHORT} SELECT k, child, copies, CASE WHEN NOT off THEN attr END AS attr, CASE WHEN off THEN 'QUARANTINE' ELSE 'ACCEPTED' END AS disposition FROM h""")
def nested_children(t):
    return _cohort(t)[1]


@query("SELECT user_id, coalesce(bool_or(event_type = 'error' AND value > 100), false) AS ever FROM events GROUP BY 1")
def sticky_any(t):
    return A.sticky_any(t("events"), ["user_id"], (F.col("event_type") == "error") & (F.col("value") > 100))


_TWO = "a AS (SELECT md5(text) AS h, count(*) AS n FROM documents WHERE doc_id % 7 != 0 GROUP BY 1), b AS (SELECT md5(text) AS h, count(*) AS n FROM documents WHERE doc_id % 11 != 0 GROUP BY 1), j AS (SELECT coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM a FULL JOIN b USING (h))"


@query(f"WITH {_TWO} SELECT CAST(sum(least(x, y)) AS BIGINT) AS unchanged, CAST(sum(greatest(x - y, 0)) AS BIGINT) AS only_a, CAST(sum(greatest(y - x, 0)) AS BIGINT) AS only_b FROM j")
def multiset_overlap(t):
    d = t("documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    return A.multiset_overlap(d.filter("doc_id % 7 != 0"), d.filter("doc_id % 11 != 0"), "h")


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 100000) AS large, count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 100000) AS both_true FROM orders GROUP BY 1")
def conditional_counts(t):
    f, l = F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000  # noqa: E741
    return A.counts_where(t("orders"), ["o_orderpriority"], {"finished": f, "large": l, "both_true": f & l})


@query("""WITH s AS (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS k, value > 1 AS ok FROM events),
p AS (SELECT event_type, k, count(*) AS n, bool_and(ok) AS ok FROM s GROUP BY 1, 2)
SELECT event_type, CAST(sum(n) AS BIGINT) AS physical, count(k) AS distinct_rows, CAST(coalesce(sum(n - 1) FILTER (k IS NOT NULL), 0) AS BIGINT) AS duplicate, CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS unidentified,
count(*) FILTER (k IS NOT NULL AND ok) AS valid, count(*) FILTER (k IS NOT NULL AND NOT ok) AS quarantined, true AS balanced FROM p GROUP BY 1""")
def volume_counts(t):
    staged = t("events").withColumn("k", F.when(F.col("event_id") % 10 != 0, F.col("user_id")))
    return A.volume_counts(staged, ["event_type"], "k", F.col("value") > 1)


@query("SELECT conv_id, string_agg(role, '>' ORDER BY turn, role) AS joined FROM conversations GROUP BY 1")
def string_agg_ordered(t):
    return A.string_agg_ordered(t("conversations"), ["conv_id"], ["turn"], "role", ">")


@query("""SELECT CAST(ts AS DATE) AS day, count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors, date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds, CASE WHEN count(*) FILTER (event_type = 'error') * 4 > count(*) THEN 'HIGH' WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'SOME' ELSE 'NONE' END AS error_class FROM events GROUP BY 1""")
def run_monitor(t):
    e = t("events").select(F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_type") == "error").alias("failed"), F.lit(1).alias("rows"))
    runs = e.groupBy("day").agg(F.min("at").alias("started"), F.max("at").alias("ended"))
    return A.run_monitor(runs, e, ["day"]).select("day", "rows", "errors", "seconds", "error_class")


@query("""WITH c AS (SELECT count(*) AS total, count(*) FILTER (value < 1) AS low, count(*) FILTER (user_id IS NULL) AS nouser, count(*) FILTER (event_type = 'error') AS err FROM events),
r AS (SELECT 'LOW_VALUE' AS check_code, low AS failed, 1000000 AS m, 500 AS bp, total FROM c UNION ALL SELECT 'NO_USER', nouser, 0, 0, total FROM c UNION ALL SELECT 'ERRORS', err, 1000000, 1000, total FROM c)
SELECT check_code, failed, total, CAST(failed * 10000 // total AS BIGINT) AS basis_points, CASE WHEN failed <= m AND failed * 10000 // total <= bp THEN 'PASS' ELSE 'FAIL' END AS result FROM r""")
def quality_gate(t):
    return A.quality_gate(t("events"), {"LOW_VALUE": (F.col("value") < 1, 1_000_000, 500), "NO_USER": (F.col("user_id").isNull(), 0, 0), "ERRORS": (F.col("event_type") == "error", 1_000_000, 1000)})


@query("""WITH c AS (SELECT count(*) FILTER (value < 1) AS a, count(*) FILTER (event_type = 'error') AS b, count(*) AS n FROM events), r AS (SELECT 'LOW_VALUE' AS check_code, a AS failed, n AS total, a * 10000 // n AS basis_points, CASE WHEN a * 10000 // n <= 500 THEN 'PASS' ELSE 'FAIL' END AS result FROM c UNION ALL SELECT 'ERRORS', b, n, b * 10000 // n, CASE WHEN b = 0 THEN 'PASS' ELSE 'FAIL' END FROM c)
SELECT * FROM r UNION ALL SELECT 'GATE', count(*) FILTER (result = 'FAIL'), 2, count(*) FILTER (result = 'FAIL') * 5000, CASE WHEN bool_and(result = 'PASS') THEN 'PASS' ELSE 'FAIL' END FROM r""")
def quality_gate_overall(t):
    return A.gated(A.quality_gate(t("events"), {"LOW_VALUE": (F.col("value") < 1, 1_000_000, 500), "ERRORS": (F.col("event_type") == "error", 0, 10_000)}))


@query("""WITH p AS (SELECT user_id AS run, event_id % 10 AS page, event_type, value, props FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 10 ORDER BY ts DESC, event_id DESC) = 1)
SELECT run, count(*) AS pages, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) FILTER (event_type = 'error') AS failed, CAST(sum(strlen(props)) AS BIGINT) AS bytes, CASE WHEN bool_or(event_type = 'error') THEN 'FAILED' WHEN count(*) < 3 THEN 'PARTIAL' WHEN run % 4 IN (0, 3) THEN 'GATED' ELSE 'OK' END AS state FROM p GROUP BY 1""")
def run_health_gated(t):
    """With the bytes of the pages; a fourth of the runs have a gate that fails, another fourth none."""
    e = t("events").withColumn("page", F.col("event_id") % 10).withColumnRenamed("user_id", "run")
    gates = e.filter("run % 4 != 3").select("run", (F.col("run") % 4 != 0).alias("passed")).distinct()
    return A.run_health(e, "run", "page", [F.desc("ts"), F.desc("event_id")], F.col("event_type") == "error", F.col("value").cast("decimal(18,2)"), 3, F.octet_length("props"), gates)


@query("""WITH p AS (SELECT user_id AS run, event_id % 10 AS page, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 10 ORDER BY ts DESC, event_id DESC) = 1)
SELECT run, count(*) AS pages, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) FILTER (event_type = 'error') AS failed, CASE WHEN bool_or(event_type = 'error') THEN 'FAILED' WHEN count(*) < 10 THEN 'PARTIAL' ELSE 'OK' END AS state FROM p GROUP BY 1""")
def run_health(t):
    """The latest attempt of each page, then totals and a state of the run."""
    attempts = t("events").withColumn("page", F.col("event_id") % 10)
    return A.run_health(attempts.withColumnRenamed("user_id", "run"), "run", "page", [F.desc("ts"), F.desc("event_id")], F.col("event_type") == "error", F.col("value").cast("decimal(18,2)"), 10)


@query("""SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'view') AS view,
CASE WHEN bool_or(event_type = 'error') THEN 'error' WHEN bool_or(event_type = 'purchase') THEN 'purchase' WHEN bool_or(event_type = 'view') THEN 'view' ELSE 'NONE' END AS overall FROM events GROUP BY 1, 2""")
def overall_state(t):
    return A.overall_state(t("events").withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_type", ["error", "purchase", "view"])


@query("SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def union_all(t):
    return sets.union_all(t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), t("region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")))


@query("SELECT (SELECT count(*) FROM (SELECT * FROM nation EXCEPT SELECT * FROM nation WHERE n_nationkey > 2)) AS only_a, 0 AS only_b, false AS same")
def same_set(t):
    return sets.same_set(t("nation"), t("nation").filter("n_nationkey > 2"))


@query("SELECT o_orderkey, o_orderkey % 6 NOT IN (0, 3) AS equal FROM orders")
def rows_equal(t):
    """An altered version of the orders, compared null-safely: every sixth has another price, every sixth no status."""
    o = t("orders")
    b = o.select("o_orderkey", F.when(F.col("o_orderkey") % 6 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("p"), F.when(F.col("o_orderkey") % 6 != 3, F.col("o_orderstatus")).alias("s"))
    j = o.join(b, "o_orderkey")
    return j.select("o_orderkey", sets.equal_columns([("o_totalprice", "p"), ("o_orderstatus", "s")]).alias("equal"))


@query(f"WITH {_TWO} SELECT CAST(sum(greatest(x - y, 0)) AS BIGINT) AS n, 'a' AS side FROM j UNION ALL SELECT CAST(sum(greatest(y - x, 0)) AS BIGINT), 'b' FROM j")
def multiset_diff(t):
    d = t("documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    diff = sets.multiset_diff(d.filter("doc_id % 7 != 0").select("h"), d.filter("doc_id % 11 != 0").select("h"), ["h"])
    return diff.groupBy("side").agg(F.sum("n").alias("n"))


@query("SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS in_group FROM orders")
def count_over(t):
    return W.count_over(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey"])


