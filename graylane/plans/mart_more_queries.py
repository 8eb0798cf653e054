"""Queries that build the marts of marts_more from captures made of the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from graylane import storage
from graylane.operators import aggregates as A
from graylane.plans import marts_more as M
from graylane.registry import query
from graylane.sources import marked


@query("""WITH n AS (SELECT 'branch' AS dim, upper(trim(n_name)) AS name, NULL AS kind FROM nation UNION ALL SELECT 'branch', upper(trim(r_name)), NULL FROM region UNION ALL SELECT 'driver', upper(trim(s_name)), NULL FROM supplier
UNION ALL SELECT 'vehicle', upper(trim(p_name)), p_type FROM part UNION ALL SELECT 'account', upper(trim(p_brand)), p_type FROM part)
SELECT dim, sha256(name) AS key, name, max(kind) AS kind FROM n WHERE name != '' GROUP BY 1, 3""")
def mart_dimensions(t):
    """Branches of two sources, drivers, vehicles with their type, accounts with their class."""
    none = F.lit(None).cast("string")
    dims = {
        "branch": [(t("nation"), F.col("n_name"), {"kind": none}), (t("region"), F.concat(F.lit(" "), F.lower("r_name")), {"kind": none})],
        "driver": [(t("supplier"), F.concat("s_name", F.lit(" ")), {"kind": none})],
        "vehicle": [(t("part"), F.col("p_name"), {"kind": F.col("p_type")})],
        "account": [(t("part"), F.lower("p_brand"), {"kind": F.col("p_type")})],
    }
    out = None
    for name, sources in dims.items():
        part = M.names(sources).select(F.lit(name).alias("dim"), "key", "name", "kind")
        out = part if out is None else out.unionByName(part)
    return out


@query("""WITH r AS (SELECT 'payer' AS role, CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS number, c_name AS name FROM customer UNION ALL SELECT 'receiver', NULL, 'nation ' || c_nationkey FROM customer UNION ALL SELECT 'sender', lpad(CAST(c_nationkey AS VARCHAR), 14, '0'), c_mktsegment FROM customer)
SELECT CASE WHEN number IS NOT NULL THEN 'doc:' || number ELSE 'name:' || upper(trim(regexp_replace(name, '\\s+', ' ', 'g'))) END AS client, max(upper(trim(name))) AS name, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM r GROUP BY 1""")
def mart_clients(t):
    c, fourteen = t("customer"), lambda col: F.lpad(F.col(col).cast("string"), 14, "0")
    docs = c.select(F.when(F.col("c_custkey") % 3 == 0, fourteen("c_custkey")).alias("pd"), "c_name", F.lit(None).cast("string").alias("rd"), F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("rn"), fourteen("c_nationkey").alias("sd"), "c_mktsegment")
    return M.clients(docs, {"payer": ("pd", "c_name"), "receiver": ("rd", "rn"), "sender": ("sd", "c_mktsegment")})


@query("SELECT user_id AS id, event_type AS name FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def mart_users(t):
    return M.users(t("events").withColumn("event_type", F.concat(F.lit(" "), "event_type")), "user_id", "event_type", [F.desc("ts"), F.desc("event_id")])


@query("""SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'On the way' ELSE o_orderstatus END AS status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,3)) AS weight, r_name AS region
FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30 LEFT JOIN region ON r_regionkey = n_regionkey""")
def mart_cargo_location(t):
    o = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.concat(F.lit("R$ "), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)).alias("text"), F.concat(F.lit("nátion_"), (F.col("o_custkey") % 30).cast("string")).alias("place"))
    regions = t("nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("aliases")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("region"), "aliases")
    return M.cargo_location(o, {"F": "Finished", "O": "On the way"}, F.col("text"), regions)


def _invoices(t):
    k = F.col("o_orderkey")
    captures = t("orders").select(
        k.alias("ordinal"), F.when(k % 4 != 0, F.concat(F.lit("K"), F.floor(k / 3).cast("string"))).alias("access_key"), F.when(k % 8 != 0, (k % 100).cast("string")).alias("number"), F.concat(F.lit("P"), (F.col("o_custkey") % 10).cast("string")).alias("party"),
        F.to_date("o_orderdate").alias("issued"), F.col("o_orderdate").alias("updated"), F.array((k % 7).cast("string"), F.lit(" "), (k % 5).cast("string")).alias("freights"), F.when(k % 2 == 0, F.lpad((F.col("o_custkey") % 20).cast("string"), 14, "0")).alias("document"),
        F.when(k % 3 == 0, F.date_add(F.to_date("o_orderdate"), 10)).alias("paid"), F.date_add(F.to_date("o_orderdate"), 30).alias("due"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    return M.current_invoices(captures, [F.desc("ordinal")])


_INVOICES = """c AS (SELECT o_orderkey AS k, sha256(CASE WHEN o_orderkey % 4 != 0 THEN 'key:K' || o_orderkey // 3 WHEN o_orderkey % 8 != 0 THEN 'number:' || o_orderkey % 100 || '|P' || o_custkey % 10 ELSE 'row:' || o_orderkey END) AS invoice, o_custkey, CAST(o_orderdate AS DATE) AS issued, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
i AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY invoice ORDER BY issued DESC, k DESC) = 1),
f AS (SELECT k, invoice, CASE WHEN k % 2 = 0 THEN 'doc:' || lpad(CAST(o_custkey % 20 AS VARCHAR), 14, '0') ELSE 'name:P' || o_custkey % 10 END AS client, CASE WHEN k % 3 = 0 AND issued + 10 <= DATE '1998-01-01' THEN 'PAID' WHEN issued + 30 < DATE '1998-01-01' THEN 'OVERDUE' ELSE 'OPEN' END AS state,
 CASE WHEN NOT (k % 3 = 0 AND issued + 10 <= DATE '1998-01-01') AND issued + 30 < DATE '1998-01-01' THEN CAST(DATE '1998-01-01' - (issued + 30) AS INTEGER) END AS days_past_due, CAST(year(issued) * 100 + month(issued) AS INTEGER) AS month, amount FROM i)"""


@query(f"WITH {_INVOICES} SELECT invoice, k AS ordinal, array_to_string(list_sort([CAST(k % 7 AS VARCHAR), CAST(k % 5 AS VARCHAR)]), ',') AS freights FROM i")
def mart_current_invoices(t):
    return _invoices(t).select("invoice", "ordinal", "freights")


@query(f"WITH {_INVOICES} SELECT invoice, client, state, days_past_due, month, amount, sha256(invoice || '|' || client || '|' || state || '|' || CAST(amount AS VARCHAR)) AS row_hash FROM f")
def mart_invoice_fact(t):
    return M.invoice_fact(_invoices(t), F.lit("1998-01-01").cast("date")).withColumn("month", F.col("month").cast("int"))


@query(f"WITH {_INVOICES} SELECT client, month, count(*) AS invoices, sum(amount) AS amount, CAST(coalesce(sum(amount) FILTER (state = 'OVERDUE'), 0) AS DECIMAL(38,2)) AS overdue FROM f GROUP BY 1, 2")
def mart_invoices_by_client(t):
    return M.invoices_by_client(M.invoice_fact(_invoices(t), F.lit("1998-01-01").cast("date"))).withColumn("month", F.col("month").cast("int"))


@query("""WITH x AS (SELECT *, o_orderkey % 500 AS trip, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 11 = 0 THEN -5 ELSE o_orderkey % 4000 END AS m FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey % 500, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1)
SELECT trip, day, CASE o_orderkey % 3 WHEN 0 THEN 'O' || o_orderkey % 5 WHEN 1 THEN 'from' END AS origin, CASE o_orderkey % 3 WHEN 0 THEN 'D' || o_orderkey % 7 WHEN 1 THEN 'to' END AS destination, CASE o_orderkey % 3 WHEN 0 THEN 'route' WHEN 1 THEN 'places' ELSE 'none' END AS source,
CASE WHEN m >= 0 THEN lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') END AS transit FROM x""")
def mart_trips(t):
    k = F.col("o_orderkey")
    minutes = F.when(k % 11 == 0, -5).otherwise(k % 4000)
    c = t("orders").select(
        k, (k % 500).alias("trip"), F.to_date("o_orderdate").alias("day"), F.when(k % 3 == 0, F.concat(F.lit("O"), (k % 5).cast("string"), F.lit(" X "), F.lit("D"), (k % 7).cast("string"))).otherwise("one place").alias("route"),
        F.when(k % 3 == 1, "from").alias("from_place"), F.when(k % 3 == 1, "to").alias("to_place"), F.col("o_orderdate").cast("timestamp").alias("left"), (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))).alias("arrived"),
    )
    return M.trips(c, [F.desc("o_orderkey")])


@query("""WITH l AS (SELECT l_suppkey AS manifest, l_orderkey, l_linenumber, l_shipdate, CAST(l_extendedprice AS DECIMAL(18,2)) AS cost, l_orderkey % 3 AS a, l_quantity AS b FROM lineitem),
n AS (SELECT manifest, cost FROM l QUALIFY row_number() OVER (PARTITION BY manifest ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, cost DESC) = 1), k AS (SELECT manifest, count(DISTINCT (a, b)) AS lines FROM l GROUP BY 1),
d AS (SELECT DISTINCT l_suppkey AS root, l_orderkey AS target FROM lineitem WHERE l_linenumber = 1), v AS (SELECT DISTINCT x.l_suppkey AS root, y.l_orderkey AS target FROM lineitem x JOIN lineitem y ON x.l_partkey = y.l_partkey WHERE x.l_linenumber = 2 AND y.l_linenumber = 3),
j AS (SELECT coalesce(d.root, v.root) AS root, coalesce(d.target, v.target) AS target, d.root IS NOT NULL AS x, v.root IS NOT NULL AS y FROM d FULL JOIN v ON d.root = v.root AND d.target = v.target),
m AS (SELECT root, coalesce(sum(p) FILTER (x), 0) AS direct_total, coalesce(sum(p) FILTER (y), 0) AS via_total, sum(p) AS total FROM j JOIN (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders) ON o_orderkey = target GROUP BY 1)
SELECT n.manifest, lines, cost, CASE WHEN n.manifest % 5 = 0 THEN 'own' WHEN n.manifest % 3 < 2 THEN 'K' || n.manifest % 3 END AS class, CASE WHEN n.manifest % 5 = 0 THEN 'exception' WHEN n.manifest % 3 < 2 THEN 'matrix' ELSE 'none' END AS class_from,
CAST(coalesce(direct_total, 0) AS DECIMAL(18,2)) AS direct_total, CAST(coalesce(via_total, 0) AS DECIMAL(18,2)) AS via_total, CAST(coalesce(total, 0) AS DECIMAL(18,2)) AS total FROM n JOIN k USING (manifest) LEFT JOIN m ON m.root = n.manifest""")
def mart_manifests(t):
    l, s = t("lineitem"), t("supplier").select(F.col("s_suppkey").alias("manifest"))  # noqa: E741
    record = F.to_json(F.struct((F.col("l_orderkey") % 3).alias("a"), F.col("l_quantity").alias("b"), F.col("l_orderkey").alias("seq")))
    lines = l.select(F.col("l_suppkey").alias("manifest"), (F.col("l_suppkey") % 3).alias("vehicle"), "l_shipdate", "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("cost"), record.alias("record"))
    steps = [("exception", s.filter("manifest % 5 = 0").withColumn("class", F.lit("own")), ["manifest"]), ("matrix", s.filter("manifest % 3 < 2").select((F.col("manifest") % 3).alias("vehicle"), F.concat(F.lit("K"), (F.col("manifest") % 3).cast("string")).alias("class")), ["vehicle"])]
    edge = lambda n, a, b: l.filter(F.col("l_linenumber") == n).select(*a, *b)
    root, target, mid = F.col("l_suppkey").alias("root"), F.col("l_orderkey").alias("target"), F.col("l_partkey").alias("mid")
    value = t("orders").select(F.col("o_orderkey").alias("target"), F.col("o_totalprice").cast("decimal(18,2)").alias("value"))
    return M.manifests(lines, ["seq"], [F.desc("l_shipdate"), F.desc("l_orderkey"), F.desc("l_linenumber"), F.desc("cost")], steps, edge(1, [root], [target]), edge(2, [root], [mid]), edge(3, [mid], [target]), value)


def _consolidated(t):
    k = F.col("o_orderkey")
    f = t("orders").select(
        k.alias("freight"), F.col("o_custkey").alias("group"), F.to_date("o_orderdate").alias("issued"), (F.col("o_orderstatus") == "F").alias("valid"), F.concat(F.lit("NATION_"), (k % 40).cast("string")).alias("branch_name"), (k % 30).cast("int").alias("branch_id"), "o_orderstatus",
        F.col("o_totalprice").alias("base"), F.when(k % 2 == 0, F.lit(1.5)).alias("toll"), F.lit(None).cast("double").alias("other"),
    )
    docs = t("lineitem").select(F.col("l_orderkey").alias("freight"), F.col("l_partkey").alias("document"), F.col("l_shipdate").alias("document_at"))
    branches = t("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"), F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("branch"))
    return M.freight_consolidated(f, docs, branches, ["base", "toll", "other"], [("status", F.col("o_orderstatus") == "P"), ("low", F.col("base") < 20000)])


_CONSOLIDATED = """o AS (SELECT o_orderkey AS k, o_custkey AS g, CAST(o_orderdate AS DATE) AS issued, o_orderstatus AS s, o_totalprice AS p, max(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS m FROM orders),
dd AS (SELECT l_orderkey, l_partkey AS document FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC) = 1),
c AS (SELECT k AS freight, g AS "group", issued, document, CASE WHEN k % 40 < 25 THEN 'B' || k % 40 WHEN k % 30 < 25 THEN 'B' || k % 30 END AS branch, CAST(CAST(p AS DECIMAL(18,2)) + CASE WHEN k % 2 = 0 THEN 1.5 ELSE 0 END AS DECIMAL(18,2)) AS total, CASE WHEN s = 'P' THEN 'status' WHEN p < 20000 THEN 'low' END AS cancelled_by
 FROM o LEFT JOIN dd ON l_orderkey = k WHERE m IS NULL OR issued >= m), e AS (SELECT *, document IS NOT NULL AND total > 0 AND cancelled_by IS NULL AS eligible FROM c)"""


@query(f"WITH {_CONSOLIDATED} SELECT * FROM e")
def mart_freight_consolidated(t):
    return _consolidated(t).withColumn("total", F.col("total").cast("decimal(18,2)"))


@query(f"""WITH {_CONSOLIDATED}, b AS (SELECT freight, branch, total, issued, issued - CASE dayofweek(issued) WHEN 0 THEN 2 WHEN 6 THEN 1 ELSE 0 END AS billed FROM e WHERE eligible)
SELECT freight, branch, total, issued, billed, CAST(year(billed) * 100 + month(billed) AS INTEGER) AS month, billed != issued AS moved, sha256(freight || '|' || coalesce(branch, '\\N') || '|' || CAST(total AS VARCHAR) || '|' || CAST(billed AS VARCHAR)) AS row_hash FROM b""")
def mart_billing(t):
    c = _consolidated(t).withColumn("total", F.col("total").cast("decimal(18,2)"))
    days = t("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    back = F.when(F.dayofweek("day") == 1, 2).when(F.dayofweek("day") == 7, 1).otherwise(0)
    return M.billing_fact(c, days.withColumn("business_day", F.date_sub("day", back))).withColumn("month", F.col("month").cast("int"))


@query("""SELECT CAST(ts AS DATE) AS day, user_id % 3 AS scope, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed FROM events WHERE NOT (day(ts) % 4 = 1 AND user_id % 3 = 2) GROUP BY 1, 2""")
def mart_occurrences(t):
    """Published with one run a scope and day; every fourth day has a second run: the first had failures as other occurrences, and what scope 2 has there is empty in the second."""
    e = t("events").select((F.col("user_id") % 3).alias("scope"), F.to_date("ts").alias("day"), "event_id", "event_type")
    spark, base = e.sparkSession, storage.new_path(e.sparkSession, "occurrences")
    marked.create(spark, base, e.schema, ["scope", "day"], StructType([StructField("run", LongType())]))
    late, empty = F.dayofmonth("day") % 4 == 1, (F.dayofmonth("day") % 4 == 1) & (F.col("scope") == 2)
    first = e.withColumn("event_type", F.when(late, "other").otherwise(F.col("event_type")))
    covered = e.groupBy("scope", "day").agg(F.count(F.lit(1)).alias("rows")).withColumn("run", F.lit(1).cast("long"))
    M.occurrences_by_day(base, first, covered)
    covered = covered.withColumn("run", F.when(late, 2).otherwise(1).cast("long")).withColumn("rows", F.when(empty, 0).otherwise(F.col("rows")))
    rows = M.occurrences_by_day(base, e.filter(~empty), covered)
    return rows.groupBy("day", "scope").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"))


@query("""WITH e AS (SELECT *, event_type AS entity, CAST(ts AS DATE) - DATE '2024-01-01' AS seq FROM events), r AS (SELECT entity, seq, CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS seconds FROM e GROUP BY 1, 2),
l AS (SELECT entity, seq, count(*) AS entries, CAST(sum(user_id % 5) AS BIGINT) AS rows, count(*) FILTER (value < 1) AS errors FROM e WHERE event_id % 4 != 0 GROUP BY 1, 2), h AS (SELECT entity, seq, user_id, count(*) AS n FROM e GROUP BY 1, 2, 3),
u AS (SELECT a.entity, a.seq, CAST(sum(least(a.n, b.n)) AS BIGINT) AS unchanged FROM h a JOIN h b ON a.entity = b.entity AND a.seq = b.seq + 1 AND a.user_id = b.user_id GROUP BY 1, 2)
SELECT r.entity, CAST(r.seq AS INTEGER) AS seq, seconds, coalesce(entries, 0) AS entries, coalesce(rows, 0) AS rows, coalesce(errors, 0) AS errors, CASE WHEN entries IS NULL THEN 'SILENT' WHEN errors * 4 > entries THEN 'HIGH' WHEN errors > 0 THEN 'SOME' ELSE 'NONE' END AS error_class, coalesce(unchanged, 0) AS unchanged
FROM r LEFT JOIN l USING (entity, seq) LEFT JOIN u USING (entity, seq)""")
def mart_execution_log(t):
    e = t("events").withColumn("entity", F.col("event_type")).withColumn("seq", F.datediff(F.to_date("ts"), F.lit("2024-01-01"))).withColumn("at", F.col("ts").cast("timestamp"))
    runs = e.groupBy("entity", "seq").agg(F.min("at").alias("started"), F.max("at").alias("ended"))
    logs = e.filter("event_id % 4 != 0").select("entity", "seq", (F.col("value") < 1).alias("failed"), (F.col("user_id") % 5).alias("rows"))
    return M.execution_log(runs, logs, e.groupBy("entity", "seq", F.col("user_id").alias("hash")).agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT o_orderpriority AS entity, o_orderstatus AS state, count(*) AS n, count(DISTINCT o_custkey) AS customers, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, CASE WHEN count(DISTINCT CAST(o_orderdate AS DATE)) >= 100 THEN 'COMPLETE' ELSE 'PARTIAL' END AS status FROM orders GROUP BY 1, 2""")
def mart_receiving_overview(t):
    o = t("orders").withColumnsRenamed({"o_orderpriority": "entity", "o_orderstatus": "state"})
    return A.overview(o, ["entity", "state"], {"customers": F.col("o_custkey"), "days": F.to_date("o_orderdate")}, {"total": F.col("o_totalprice").cast("decimal(18,2)")}, "o_orderdate", ("days", 100))
