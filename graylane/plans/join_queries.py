"""Queries that prove the joins on the supplied tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from graylane.functions import scalar as S
from graylane.operators import intervals as I
from graylane.operators import joins as J
from graylane.operators import relations as R
from graylane.registry import query


@query("""WITH l AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT n_name, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' ELSE o_orderstatus END AS status, count(DISTINCT o_orderkey) AS orders, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS net
FROM l JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def enrich_latest(t):
    """Net price of the lines of each customer's latest order, by nation and status: the flagship."""
    latest = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    latest = J.enrich_latest(latest, t("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    lines = t("lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("v"))
    j = latest.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(J.small(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", S.label(F.col("o_orderstatus"), {"O": "Open", "F": "Finished"}).alias("status")).agg(F.count_distinct("o_orderkey").alias("orders"), F.sum("v").alias("net"))


@query("""SELECT c_custkey, coalesce(a.n_name, b.n_name) AS place FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 != 0 THEN c_nationkey END AS k, 'NATION_' || c_nationkey % 7 AS label FROM customer) c
LEFT JOIN nation a ON a.n_nationkey = c.k LEFT JOIN nation b ON b.n_name = c.label""")
def lookup_fallback(t):
    """By id, else by name."""
    c = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("k"), F.concat(F.lit("NATION_"), (F.col("c_nationkey") % 7).cast("string")).alias("label"))
    n = t("nation").select("n_nationkey", "n_name", F.col("n_name").alias("value"))
    return J.lookup_first(c, n, [("k", "n_nationkey"), ("label", "n_name")], "value", "place").select("c_custkey", "place")


@query("""WITH r AS (SELECT n_nationkey AS o, n_regionkey AS d, CAST(n_nationkey * 1.5 + n_regionkey AS DECIMAL(19,4)) AS amount FROM nation WHERE n_nationkey % 4 != 0)
SELECT c_custkey, coalesce(amount, 0) AS tariff FROM customer LEFT JOIN r ON o = c_nationkey AND d = c_custkey % 5""")
def tariff_lookup(t):
    r = t("nation").filter("n_nationkey % 4 != 0").select(F.col("n_nationkey").alias("o"), F.col("n_regionkey").cast("long").alias("d"), F.expr("cast(n_nationkey * 1.5 + n_regionkey as decimal(19,4))").alias("amount"))
    j = t("customer").join(J.small(r), (F.col("o") == F.col("c_nationkey")) & (F.col("d") == F.col("c_custkey") % 5), "left")
    return j.select("c_custkey", F.coalesce("amount", F.lit(0).cast("decimal(19,4)")).alias("tariff"))


@query("""WITH a AS (SELECT n_nationkey AS k, lower(unnest([n_name, 'PAIS ' || n_nationkey])) AS a FROM nation), b AS (SELECT a, min(k) AS k FROM a GROUP BY 1)
SELECT c_custkey, k FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'nation_' || c_nationkey WHEN c_custkey % 3 = 1 THEN 'país ' || c_nationkey ELSE 'none' END AS x FROM customer) LEFT JOIN b ON a = strip_accents(lower(x))""")
def alias_join(t):
    n = t("nation").select(F.col("n_nationkey").alias("k"), F.array("n_name", F.concat(F.lit("PAIS "), F.col("n_nationkey").cast("string"))).alias("aliases"))
    key, i = F.col("c_nationkey").cast("string"), F.col("c_custkey") % 3
    c = t("customer").select("c_custkey", F.when(i == 0, F.concat(F.lit("nation_"), key)).when(i == 1, F.concat(F.lit("país "), key)).otherwise("none").alias("x"))
    return J.alias_join(c, n, "x", "aliases", ["k"], S.folded).select("c_custkey", "k")


@query("""WITH l AS (SELECT o_orderkey AS k, o_orderdate AS u FROM orders WHERE o_orderkey % 5 != 0), d AS (SELECT o_orderkey AS k, o_orderdate + INTERVAL 1 DAY * CAST(o_orderkey % 3 - 1 AS INTEGER) AS x FROM orders WHERE o_orderkey % 4 = 0)
SELECT k, CASE WHEN x IS NOT NULL AND (u IS NULL OR x > u) THEN 'DELETED' ELSE 'LIVE' END AS state FROM l FULL JOIN d USING (k)""")
def with_tombstones(t):
    o = t("orders")
    live = o.filter("o_orderkey % 5 != 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("u"))
    gone = o.filter("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("k"), F.expr("o_orderdate + make_dt_interval(cast(o_orderkey % 3 - 1 as int))").alias("x"))
    return J.with_tombstones(live, gone, "k", "u", "x").select("k", "state")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS large FROM customer")
def flag_exists(t):
    o = t("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.flag_exists(t("customer").select("c_custkey"), o, ["c_custkey"], "large")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def insert_missing(t):
    return t("customer").select("c_custkey").join(t("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("""WITH i AS (SELECT n_nationkey AS k, y, make_date(y, 1, 1) AS lo, make_date(y + 1, 1, 1) AS hi FROM nation, range(1995, 2002) r(y) WHERE (n_nationkey + y) % 4 != 0)
SELECT o_orderkey, y AS release FROM (SELECT o_orderkey, o_custkey % 25 AS k, CAST(o_orderdate AS DATE) AS d FROM orders) o LEFT JOIN i ON i.k = o.k AND d >= lo AND d < hi""")
def interval_asof(t):
    """The yearly release of the key that holds on the order's date; every fourth is revoked."""
    i = t("nation").select(F.col("n_nationkey").cast("long").alias("k"), F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("release")).filter((F.col("k") + F.col("release")) % 4 != 0)
    i = i.withColumn("lo", F.make_date("release", F.lit(1), F.lit(1))).withColumn("hi", F.make_date(F.col("release") + 1, F.lit(1), F.lit(1)))
    o = t("orders").select("o_orderkey", (F.col("o_custkey") % 25).alias("k"), F.to_date("o_orderdate").alias("d"))
    return I.interval_join(o, i, ["k"], "d", "lo", "hi").select("o_orderkey", F.col("release").cast("long").alias("release"))


@query("""SELECT l_orderkey, l_linenumber, r.day AS release FROM lineitem LEFT JOIN (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders) r
ON r.o_custkey = l_orderkey % (SELECT count(*) FROM customer) + 1 AND CAST(l_shipdate AS DATE) >= r.day AND CAST(l_shipdate AS DATE) < least(r.day + 100, coalesce((SELECT min(CAST(o_orderdate AS DATE)) FROM orders n WHERE n.o_custkey = r.o_custkey AND CAST(n.o_orderdate AS DATE) > r.day), DATE '2100-01-01'))""")
def interval_merge(t):
    """By a merge instead of a broadcast: each customer's order days open an interval of 100 days, cut by the next one; a key with more than 300 lines is cut by date."""
    l, o, n = t("lineitem"), t("orders"), t("customer").count()  # noqa: E741
    days = o.select("o_custkey", F.to_date("o_orderdate").alias("release")).distinct()
    nxt = F.lead("release").over(Window.partitionBy("o_custkey").orderBy("release"))
    i = days.select(F.col("o_custkey").alias("k"), "release", F.col("release").alias("lo"), F.least(F.date_add("release", 100), F.coalesce(nxt, F.lit("2100-01-01").cast("date"))).alias("hi"))
    fact = l.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % n + 1).alias("k"), F.to_date("l_shipdate").alias("d"))
    return I.merged(fact, i, ["k"], "d", "lo", "hi", hot_rows=300).select("l_orderkey", "l_linenumber", "release")


@query("""WITH r AS (SELECT s_suppkey AS p, s_suppkey * 1000000007 AS lo, s_suppkey * 1000000007 + 10000000000 AS hi FROM supplier)
SELECT o_orderkey, 'R' || (SELECT min(p) FROM r WHERE o_orderkey * 65537 BETWEEN lo AND hi) AS region FROM orders""")
def ranged_wide(t):
    """Overlapping ranges of ten thousand million numbers each."""
    i, o = F.col("s_suppkey").cast("long"), t("orders").select("o_orderkey", (F.col("o_orderkey") * 65537).alias("num"), F.lit("none").alias("city"))
    none = F.lit(None).cast("string").alias("label")
    rules = t("supplier").select(F.lit("RANGE").alias("kind"), i.alias("priority"), (i * 1000000007).alias("lo"), (i * 1000000007 + 10000000000).alias("hi"), none, F.concat(F.lit("R"), i.cast("string")).alias("region"))
    return I.ranged_first(o, rules, "num", "city").select("o_orderkey", "region")


@query("""WITH r AS (SELECT n_nationkey AS p, n_nationkey * 50 AS lo, n_nationkey * 50 + 29 AS hi, NULL AS label, 'R' || n_nationkey AS region FROM nation),
m AS (SELECT n_nationkey AS p, n_name AS label, 'N' || n_nationkey AS region FROM nation WHERE n_nationkey % 2 = 0)
SELECT c_custkey, coalesce(r.region, m.region) AS region FROM customer LEFT JOIN r ON c_custkey % 1000 BETWEEN lo AND hi LEFT JOIN m ON m.label = 'NATION_' || c_nationkey""")
def ranged_first(t):
    n = t("nation").select(F.col("n_nationkey").cast("long").alias("i"), "n_name")
    tag = lambda p: F.concat(F.lit(p), F.col("i").cast("string"))
    ranges = n.select(F.lit("RANGE").alias("kind"), F.col("i").alias("priority"), (F.col("i") * 50).alias("lo"), (F.col("i") * 50 + 29).alias("hi"), F.lit(None).cast("string").alias("label"), tag("R").alias("region"))
    names = n.filter("i % 2 = 0").select(F.lit("NAME").alias("kind"), F.col("i").alias("priority"), F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), F.col("n_name").alias("label"), tag("N").alias("region"))
    c = t("customer").select("c_custkey", (F.col("c_custkey") % 1000).alias("num"), F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("city"))
    return I.ranged_first(c, ranges.unionByName(names), "num", "city").select("c_custkey", "region")


@query("""SELECT o_orderkey, f AS flag FROM orders LEFT JOIN (SELECT l_orderkey, CASE WHEN min(l_returnflag) = max(l_returnflag) THEN min(l_returnflag) END AS f FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def unique_lookup(t):
    return J.unique_lookup(t("orders").select("o_orderkey"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag"), ["o_orderkey"], "l_returnflag", "flag")


@query("""WITH a AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id % 7 END AS k FROM (SELECT DISTINCT user_id FROM events)), b AS (SELECT k, count(*) AS n FROM a GROUP BY 1)
SELECT user_id, n FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def null_safe_join(t):
    a = t("events").select("user_id").distinct().withColumn("k", F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 7))
    return J.null_safe_join(a, a.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"]).select("user_id", "n")


@query("""WITH p AS (SELECT l_orderkey AS d, min(l_suppkey) AS lo, max(l_suppkey) AS hi FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1)
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END, CASE WHEN lo = hi THEN lo END) AS party FROM orders LEFT JOIN p ON d = o_orderkey""")
def single_fallback(t):
    fact = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("party"))
    return J.single_fallback(fact, t("lineitem").filter("l_suppkey % 2 = 0").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("party")), "o_orderkey", "party").select("o_orderkey", "party")


@query("SELECT event_id, max(ts) FILTER (event_type != 'error') OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM events")
def previous_run(t):
    return J.previous_run(t("events"), ["user_id"], "ts", F.col("event_type") != "error").select("event_id", "previous")


@query("""SELECT o_orderkey, 'customer' AS role, o_custkey AS id FROM orders UNION ALL SELECT o_orderkey, 'clerk', o_orderkey % 100 FROM orders""")
def role_unpivot(t):
    o = t("orders").select("o_orderkey", F.col("o_custkey").alias("customer"), (F.col("o_orderkey") % 100).alias("clerk"))
    return o.unpivot("o_orderkey", ["customer", "clerk"], "role", "id")


@query("""SELECT o_orderkey, CASE WHEN k IS NULL THEN NULL ELSE pos END AS pos, k AS part FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 4 = 0 THEN [NULL] ELSE [o_orderkey % 10, o_orderkey % 7] END) AS k, unnest(CASE WHEN o_orderkey % 4 = 0 THEN [NULL] ELSE [0, 1] END) AS pos FROM orders)""")
def children_explode(t):
    """JSON arrays of children to rows with their place; an order without any keeps a row."""
    json = F.when(F.col("o_orderkey") % 4 == 0, F.lit("[]")).otherwise(F.format_string('[{"p": %d}, {"p": %d}]', F.col("o_orderkey") % 10, F.col("o_orderkey") % 7))
    rows = t("orders").select("o_orderkey", F.posexplode_outer(F.from_json(json, "array<struct<p: bigint>>")).alias("pos", "child"))
    return rows.select("o_orderkey", "pos", F.col("child.p").alias("part"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) - CASE dayofweek(o_orderdate) WHEN 0 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS billing FROM orders")
def billing_day(t):
    """The date moved back to a business day by a calendar table."""
    o = t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    lo, hi = o.agg(F.min("d"), F.max("d")).first()
    days = o.sparkSession.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("d")) if lo else o.select("d")
    back = F.when(F.dayofweek("d") == 1, 2).when(F.dayofweek("d") == 7, 1).otherwise(0)
    return o.join(J.small(days.withColumn("billing", F.date_sub("d", back))), "d", "left").select("o_orderkey", "billing")


_EVIDENCE = """SELECT DISTINCT * FROM (
SELECT 'MC' AS kind, l_orderkey AS o, l_linenumber % 3 AS oc, l_orderkey * 4 + l_linenumber // 2 AS t, CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END AS tc, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_orderkey % 5 = 0 THEN l_linenumber ELSE 1 END AS rev,
  CASE WHEN l_orderkey % 4 = 0 THEN 'ONE_TO_ONE' WHEN l_orderkey % 4 = 2 OR l_orderkey % 4 = 3 AND l_suppkey % 10 = 0 THEN 'MANY_TO_MANY' ELSE 'ONE_TO_MANY' END AS card FROM lineitem
UNION ALL SELECT 'CF', l_orderkey * 4 + l_linenumber // 2, l_suppkey % 2, l_partkey * 10 + l_suppkey % 10, l_linenumber % 2, CAST(l_shipdate AS DATE), 1, CASE WHEN l_orderkey % 3 = 0 THEN 'MANY_TO_MANY' ELSE 'ONE_TO_MANY' END FROM lineitem
UNION ALL SELECT 'FD', l_partkey * 10 + l_suppkey % 10, l_linenumber % 2, l_suppkey, 0, NULL, 1, 'MANY_TO_MANY' FROM lineitem)"""


@query(f"""WITH RECURSIVE b AS ({_EVIDENCE}), n AS (SELECT *, dense_rank() OVER (PARTITION BY kind, o, oc ORDER BY rev DESC) AS rk FROM b), c AS (SELECT * FROM n WHERE rk = 1),
roots AS (SELECT 'MC' AS kind, 'o' AS side, o_orderkey AS id FROM orders WHERE o_orderkey % 6 != 0 UNION SELECT unnest(['MC', 'CF']), unnest(['t', 'o']), l_orderkey * 4 + l_linenumber // 2 FROM lineitem WHERE l_partkey % 9 != 0
  UNION SELECT unnest(['CF', 'FD']), unnest(['t', 'o']), l_partkey * 10 + l_suppkey % 10 FROM lineitem WHERE l_partkey % 7 != 0 UNION SELECT 'FD', 't', s_suppkey FROM supplier WHERE s_suppkey % 5 != 0),
comps AS (SELECT 'MC' AS kind, 'o' AS side, l_orderkey AS id, l_linenumber % 3 AS comp FROM lineitem WHERE l_partkey % 8 != 0 UNION SELECT 'CF', 'o', l_orderkey * 4 + l_linenumber // 2, l_suppkey % 2 FROM lineitem WHERE l_partkey % 6 != 0
  UNION SELECT unnest(['CF', 'FD']), unnest(['t', 'o']), l_partkey * 10 + l_suppkey % 10, l_linenumber % 2 FROM lineitem WHERE l_orderkey % 4 != 0),
d AS (SELECT *, CASE WHEN rk != 1 THEN 'SUPERSEDED'
  WHEN EXISTS (FROM c x WHERE x.kind = n.kind AND x.o = n.o AND x.oc = n.oc AND x.card != n.card) THEN 'CONFLICT'
  WHEN card = 'ONE_TO_ONE' AND EXISTS (FROM c x WHERE x.kind = n.kind AND x.o = n.o AND x.oc = n.oc AND (x.t != n.t OR x.tc != n.tc OR x.d != n.d)) THEN 'CONFLICT'
  WHEN card != 'MANY_TO_MANY' AND EXISTS (FROM c x WHERE x.kind = n.kind AND x.t = n.t AND x.tc = n.tc AND (x.o != n.o OR x.oc != n.oc)) THEN 'CONFLICT'
  WHEN NOT EXISTS (FROM roots r WHERE r.kind = n.kind AND side = 'o' AND id = n.o) THEN 'ORIGIN_ABSENT' WHEN NOT EXISTS (FROM comps r WHERE r.kind = n.kind AND side = 'o' AND id = n.o AND comp = n.oc) THEN 'COMPONENT_ABSENT'
  WHEN NOT EXISTS (FROM roots r WHERE r.kind = n.kind AND side = 't' AND id = n.t) THEN 'ORPHAN' WHEN kind != 'CF' AND tc != 0 THEN 'CONFLICT'
  WHEN kind = 'CF' AND NOT EXISTS (FROM comps r WHERE r.kind = 'CF' AND side = 't' AND id = n.t AND comp = n.tc) THEN 'COMPONENT_ABSENT' ELSE 'RESOLVED' END AS s FROM n),
alive AS (SELECT kind, t FROM d WHERE s = 'RESOLVED' AND kind = 'MC' UNION SELECT d.kind, d.t FROM alive a JOIN d ON d.o = a.t AND d.s = 'RESOLVED' AND (a.kind, d.kind) IN (('MC', 'CF'), ('CF', 'FD')))
SELECT kind, o AS origin, oc AS origin_component, t AS target, tc AS target_component, d AS target_date, rev AS revision,
  CASE WHEN s = 'RESOLVED' AND kind != 'MC' AND NOT EXISTS (FROM alive a WHERE a.t = d.o AND (a.kind, d.kind) IN (('MC', 'CF'), ('CF', 'FD'))) THEN 'CHAIN_BLOCKED' ELSE s END AS disposition FROM d""")
def resolve_relations(t):
    """Three kinds in a chain, with superseded, repeated, mixed, two-sided and missing evidence."""
    l, long = t("lineitem"), lambda c: F.expr(c).cast("long")  # noqa: E731, E741
    pickup, freight, ship = "l_orderkey * 4 + l_linenumber div 2", "l_partkey * 10 + l_suppkey % 10", F.to_date("l_shipdate")
    card = F.expr("case when l_orderkey % 4 = 0 then 'ONE_TO_ONE' when l_orderkey % 4 = 2 or l_orderkey % 4 = 3 and l_suppkey % 10 = 0 then 'MANY_TO_MANY' else 'ONE_TO_MANY' end")
    edge = lambda kind, o, oc, to, tc, d, rev, card: l.select(*[c.alias(n) for c, n in zip((F.lit(kind), long(o), long(oc), long(to), long(tc), d, long(rev), card), R.EDGE, strict=True)])
    bindings = edge("MC", "l_orderkey", "l_linenumber % 3", pickup, "if(l_partkey % 31 = 0, 1, 0)", ship, "if(l_orderkey % 5 = 0, l_linenumber, 1)", card)
    bindings = bindings.unionByName(edge("CF", pickup, "l_suppkey % 2", freight, "l_linenumber % 2", ship, "1", F.expr("if(l_orderkey % 3 = 0, 'MANY_TO_MANY', 'ONE_TO_MANY')")))
    bindings = bindings.unionByName(edge("FD", freight, "l_linenumber % 2", "l_suppkey", "0", F.lit(None).cast("date"), "1", F.lit("MANY_TO_MANY")))
    entity = lambda df, name, where, key, *comp: df.filter(where).select(F.lit(name).alias("entity"), long(key).alias("id"), *[long(c).alias("component") for c in comp])
    roots = entity(t("orders"), "manifest", "o_orderkey % 6 != 0", "o_orderkey").unionByName(entity(l, "pickup", "l_partkey % 9 != 0", pickup)).unionByName(entity(l, "freight", "l_partkey % 7 != 0", freight)).unionByName(entity(t("supplier"), "invoice", "s_suppkey % 5 != 0", "s_suppkey"))
    components = entity(l, "manifest", "l_partkey % 8 != 0", "l_orderkey", "l_linenumber % 3").unionByName(entity(l, "pickup", "l_partkey % 6 != 0", pickup, "l_suppkey % 2")).unionByName(entity(l, "freight", "l_orderkey % 4 != 0", freight, "l_linenumber % 2"))
    ends = l.sparkSession.createDataFrame([("MC", "manifest", "pickup", 0), ("CF", "pickup", "freight", None), ("FD", "freight", "invoice", 0)], "kind string, origin_entity string, target_entity string, root_target long")
    return R.resolve_relations(bindings, roots, components, ends, [("MC", "CF"), ("CF", "FD")]).drop("cardinality")


@query("""WITH v AS (SELECT s_suppkey AS target, CAST(s_acctbal AS DECIMAL(18,2)) AS value FROM supplier), d AS (SELECT DISTINCT o_custkey AS root, l_suppkey AS target FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1),
w AS (SELECT DISTINCT o_custkey AS root, l_partkey % (SELECT count(*) FROM supplier) AS target FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 2),
j AS (SELECT coalesce(d.root, w.root) AS root, coalesce(d.target, w.target) AS target, d.root IS NOT NULL AS x, w.root IS NOT NULL AS y FROM d FULL JOIN w ON d.root = w.root AND d.target = w.target)
SELECT root, coalesce(sum(value) FILTER (x), 0) AS direct_total, coalesce(sum(value) FILTER (y), 0) AS via_total, coalesce(sum(value) FILTER (x AND y), 0) AS shared_total,
coalesce(sum(value) FILTER (x), 0) + coalesce(sum(value) FILTER (y), 0) - coalesce(sum(value) FILTER (x AND y), 0) AS total FROM j JOIN v USING (target) GROUP BY 1""")
def path_union(t):
    o, l, s = t("orders"), t("lineitem"), t("supplier")  # noqa: E741
    n = s.count()
    direct = o.join(l.filter("l_linenumber = 1"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("root"), F.col("l_suppkey").alias("target"))
    first = o.select(F.col("o_custkey").alias("root"), F.col("o_orderkey").alias("mid"))
    second = l.filter("l_linenumber = 2").select(F.col("l_orderkey").alias("mid"), (F.col("l_partkey") % max(n, 1)).alias("target"))
    return J.path_union(direct, first, second, s.select(F.col("s_suppkey").alias("target"), F.col("s_acctbal").cast("decimal(18,2)").alias("value")))


@query("""SELECT l_returnflag, l_orderkey, l_suppkey, l_linenumber FROM (SELECT DISTINCT l_returnflag, l_orderkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_suppkey END AS k FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_orderkey, k ORDER BY l_linenumber DESC, l_suppkey DESC) = 1""")
def current_edges(t):
    e = t("lineitem").select("l_returnflag", "l_orderkey", "l_suppkey", "l_linenumber").distinct()
    return J.current_edges(e, "l_returnflag", ["A"], "l_orderkey", "l_suppkey", "l_linenumber")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'OWN' WHEN c_nationkey % 3 = 0 THEN 'CONTRACT' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'THIRD' END AS class, CASE WHEN c_custkey % 50 = 0 THEN 'exception' WHEN c_nationkey % 3 = 0 THEN 'matrix' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'token' ELSE 'none' END AS class_from FROM customer""")
def classify_chain(t):
    c = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    exceptions = c.filter("c_custkey % 50 = 0").select("c_custkey", F.lit("OWN").alias("class"))
    matrix = t("nation").filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.lit("CONTRACT").alias("class"))
    tokens = c.sparkSession.createDataFrame([("HOUSEHOLD", "THIRD")], "c_mktsegment string, class string")
    return J.classify_chain(c, [("exception", exceptions, ["c_custkey"]), ("matrix", matrix, ["c_nationkey"]), ("token", tokens, ["c_mktsegment"])]).select("c_custkey", "class", "class_from")
