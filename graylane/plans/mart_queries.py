"""Queries that build the marts from captures made of the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graylane.plans import marts as M
from graylane.registry import query


@query("""WITH t AS (SELECT n_nationkey AS o, n_regionkey AS d, CAST(n_nationkey + 0.5 AS DECIMAL(19,4)) AS amount FROM nation)
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'Converted' WHEN o_orderkey % 3 = 1 THEN 'Rejected' ELSE 'Pending' END AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS total, coalesce(amount, 0) AS tariff FROM orders LEFT JOIN t ON o = o_custkey % 25 AND d = o_orderkey % 5""")
def mart_quotes(t):
    k = F.col("o_orderkey")
    record = F.struct(k.alias("id"), (F.col("o_custkey") % 25).alias("origin"), (k % 5).alias("destination"), F.when(k % 3 == 0, "inv").alias("invoice"), F.when(k % 3 < 2, "no").alias("comment"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    captures = t("orders").select(F.to_json(F.struct(F.lit("quote").alias("entity"), record.alias("record"))).alias("envelope"))
    tariffs = t("nation").select(F.col("n_nationkey").cast("long").alias("origin"), F.col("n_regionkey").cast("long").alias("destination"), (F.col("n_nationkey") + F.lit(0.5)).cast("decimal(19,4)").alias("amount"))
    return M.quotes(captures, tariffs)


@query("""WITH y AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM range(1990, 2010) r(y)), h AS (SELECT *, (19 * a + b - b // 4 - (8 * b + 13) // 25 + 15) % 30 AS h FROM y), l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM h),
e AS (SELECT y, make_date(y, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) // 31, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) % 31 + 1) AS e FROM l),
d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), x AS (SELECT day, CASE WHEN day = e - 47 THEN 'carnival' WHEN day = e - 2 THEN 'good friday' WHEN day = e THEN 'easter' WHEN day = e + 60 THEN 'corpus christi' WHEN strftime(day, '%m%d') IN ('0101', '1225') THEN 'fixed' END AS holiday FROM d JOIN e ON y = year(day)),
z AS (SELECT *, holiday IS NULL AND dayofweek(day) NOT IN (0, 6) AS business FROM x)
SELECT day, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(weekofyear(day) AS INTEGER) AS iso_week, holiday, business, max(CASE WHEN business THEN day END) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS business_day FROM z""")
def mart_calendar(t):
    days = t("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    fixed = days.sparkSession.createDataFrame([(1, 1), (12, 25)], "month int, dom int")
    return M.calendar(days, fixed)


@query("SELECT sha256(user_id || '|' || event_type) AS claim, strftime(ts, '%H:%M:%S') AS clock, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1")
def mart_claims(t):
    return M.claims(t("events"), ["user_id", "event_type"], "ts").select("claim", "clock", "event_id")


@query("""WITH f AS (SELECT user_id, bool_or(event_type = 'purchase' AND value > 80) AS ever FROM events GROUP BY 1) SELECT e.user_id, event_id, ever AS ever_received FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e JOIN f USING (user_id)""")
def mart_inventory(t):
    return M.inventory(t("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], (F.col("event_type") == "purchase") & (F.col("value") > 80)).select("user_id", "event_id", "ever_received")


@query("SELECT o_custkey, o_orderkey, o_orderpriority AS kind, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def mart_payables(t):
    money = F.concat(F.lit("R$ "), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2))
    return M.payables(t("orders"), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], F.concat(F.lit("Debt::"), "o_orderpriority"), {"amount": money}).select("o_custkey", "o_orderkey", "kind", "amount")


@query("SELECT conv_id AS trip, role AS place, max(turn) AS turn FROM conversations GROUP BY 1, 2")
def mart_stops(t):
    c = t("conversations").groupBy(F.col("conv_id").alias("trip")).agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("place")))).alias("stops"))
    return M.trips(c, F.col("stops"))[1].select("trip", "place", "turn")


@query("SELECT CAST(ts AS DATE) AS day, user_id % 10 AS branch, count(*) AS planned, count(*) FILTER (event_type = 'purchase') AS done, count(*) FILTER (event_type = 'purchase') / count(*) AS ratio FROM events GROUP BY 1, 2")
def mart_utilisation(t):
    e = t("events").select(F.to_date("ts").alias("day"), (F.col("user_id") % 10).alias("branch"), "event_type")
    return M.utilisation(e.drop("event_type"), e.filter("event_type = 'purchase'").drop("event_type"))


def _detail(t):
    freights = t("orders").select(F.col("o_orderkey").alias("freight"), F.date_add(F.to_date("o_orderdate"), 60).alias("promised"), "o_orderpriority")
    money = lambda c, n: c.cast("decimal(18,4)").alias(n)
    lines = t("lineitem").select(F.col("l_orderkey").alias("freight"), money(F.col("l_extendedprice"), "gross"), money(F.col("l_extendedprice") * (1 - F.col("l_discount")), "net"), F.to_date("l_shipdate").alias("shipped"))
    return freights, M.freight_detail(freights, lines)


_DETAIL = """d AS (SELECT o_orderkey AS freight, o_orderpriority, gross, net, date_diff('day', CAST(o_orderdate AS DATE) + 60, shipped) AS days_late FROM orders LEFT JOIN
 (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS gross, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS net, max(CAST(l_shipdate AS DATE)) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


@query(f"""WITH {_DETAIL} SELECT freight, gross, net, CAST(days_late AS INTEGER) AS days_late, CASE WHEN days_late <= -4 THEN '-4 or less' WHEN days_late >= 4 THEN '+4 or more' WHEN days_late > 0 THEN '+' || days_late ELSE CAST(days_late AS VARCHAR) END AS band, coalesce(days_late <= 0, false) AS on_time FROM d""")
def mart_freight_detail(t):
    return _detail(t)[1]


@query(f"WITH {_DETAIL} SELECT o_orderpriority, count(*) AS freights, count(*) FILTER (days_late <= 0) AS on_time, count(*) FILTER (days_late <= 0) * 10000 // count(*) AS basis_points FROM d WHERE days_late IS NOT NULL GROUP BY 1")
def mart_indicators(t):
    freights, detail = _detail(t)
    return M.indicators(detail.join(freights.select("freight", "o_orderpriority"), "freight"), ["o_orderpriority"])


@query("""WITH i AS (SELECT n_nationkey AS payer, make_date(y, 1, 1) AS lo, make_date(y + 1, 1, 1) AS hi, n_nationkey % 3 != 0 AS eligible FROM nation, range(1996, 2001) r(y))
SELECT o_orderkey AS freight, o.payer, day, s AS disposition, CASE WHEN s = 'READY' THEN amount END AS amount FROM (SELECT o.*, CASE WHEN o_orderkey % 10 = 0 THEN 'BLOCKED_RELATION' WHEN eligible IS NULL THEN 'NO_TERMS' WHEN NOT eligible THEN 'INELIGIBLE' ELSE 'READY' END AS s
FROM (SELECT o_orderkey, o_custkey % 25 AS payer, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders) o LEFT JOIN i ON i.payer = o.payer AND day >= lo AND day < hi) o""")
def mart_revenue(t):
    f = t("orders").select(F.col("o_orderkey").alias("freight"), (F.col("o_custkey") % 25).alias("payer"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    terms = t("nation").select(F.col("n_nationkey").cast("long").alias("payer"), F.explode(F.sequence(F.lit(1996), F.lit(2000))).alias("y"), (F.col("n_nationkey") % 3 != 0).alias("eligible"))
    terms = terms.select("payer", F.make_date("y", F.lit(1), F.lit(1)).alias("lo"), F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).alias("hi"), "eligible")
    return M.revenue_fact(f, terms, f.filter("freight % 10 = 0").select("freight"))


@query("""WITH l AS (SELECT user_id AS pickup, ts AS updated, event_type AS status FROM events WHERE event_type != 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) = 1), d AS (SELECT user_id AS pickup, max(ts) AS x FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT pickup, status, CASE WHEN x IS NOT NULL AND (updated IS NULL OR x > updated) THEN 'DELETED' ELSE 'LIVE' END AS state FROM l FULL JOIN d USING (pickup)""")
def mart_pickups(t):
    e = t("events")
    live = e.filter("event_type != 'error'").select(F.col("user_id").alias("pickup"), F.col("ts").alias("updated"), F.col("event_type").alias("status"))
    gone = e.filter("event_type = 'error'").groupBy(F.col("user_id").alias("pickup")).agg(F.max("ts").alias("deleted_at"))
    return M.pickups(live, gone).select("pickup", "status", "state")


@query("""WITH l AS (SELECT l_orderkey AS document, l_linenumber AS line, CASE WHEN l_linenumber % 2 = 0 THEN min(l_suppkey) END AS client, CAST(round(sum(CAST(l_quantity AS DECIMAL(18,4))) * 10000) AS HUGEINT) AS v FROM lineitem GROUP BY 1, 2),
o AS (SELECT document, CASE WHEN min(client) = max(client) THEN min(client) END AS sole FROM l GROUP BY 1), j AS (SELECT l.*, coalesce(client, sole) AS party, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 100) AS HUGEINT) AS t FROM l JOIN o USING (document) JOIN orders ON o_orderkey = document),
u AS (SELECT *, CAST(sum(v) OVER (PARTITION BY document ORDER BY line) AS HUGEINT) AS u, CAST(sum(v) OVER (PARTITION BY document) AS HUGEINT) AS s FROM j)
SELECT document, line, party AS client, CAST(((2 * t * u + s) // (2 * s) - (2 * t * (u - v) + s) // (2 * s)) / 100 AS DECIMAL(18,2)) AS share FROM u""")
def mart_receivables(t):
    """Each line's share of its document's instalments and the client that it falls to."""
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("line")).agg(F.min("l_suppkey").alias("client"), F.sum(F.col("l_quantity").cast("decimal(18,4)")).alias("weight"))
    lines = lines.withColumn("client", F.when(F.col("line") % 2 == 0, F.col("client")))
    return M.receivables(lines, t("orders").select(F.col("o_orderkey").alias("document"), F.col("o_totalprice").cast("decimal(18,2)").alias("value")))
