"""Queries that build the marts of marts_contracts from captures made of the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graylane import storage
from graylane.operators import quality as Q
from graylane.operators import relations as R
from graylane.plans import marts_contracts as M
from graylane.plans.marts import calendar
from graylane.registry import query


def _expr(df, **columns):
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


@query("""WITH t AS (SELECT o_orderkey AS trip, o_orderdate AS ps, o_orderdate + (o_orderkey * 41 % 50000 - 60) * INTERVAL 1 MINUTE AS pe, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey * 37 % 60000 - 100 END AS m, o_custkey,
 CASE o_orderkey % 6 WHEN 0 THEN 'CITY A/SP/BRASIL ATE TOWN-B' WHEN 1 THEN NULL WHEN 2 THEN ' ATE X' WHEN 3 THEN 'ONLY' WHEN 4 THEN 'A-1 ATE B/2 ATE C' ELSE ' ' END AS route FROM orders WHERE o_orderkey % 21 != 0),
s AS (SELECT l_orderkey AS trip, l_linenumber AS place, CASE WHEN l_linenumber % 3 = 0 THEN 1000 + l_suppkey END AS city, CASE l_linenumber % 2 WHEN 0 THEN '' ELSE 'D' || l_suppkey END AS doc, CASE WHEN l_linenumber % 2 = 1 THEN l_shipdate + INTERVAL 90 MINUTE END AS pa, l_shipdate AS x FROM lineitem WHERE l_linenumber > 1 AND l_partkey % 10 != 0),
r AS (SELECT t.*, s.* EXCLUDE trip, nullif(trim(replace(replace(route, '/BRASIL', ''), ' ATE ', '|'), ' '), '') AS n, epoch(date_trunc('minute', coalesce(pa, pe))) // 60 - epoch(date_trunc('minute', ps)) // 60 AS q FROM t LEFT JOIN s ON s.trip = t.trip),
u AS (SELECT *, CASE WHEN contains(n, '|') THEN nullif(trim(split_part(n, '|', 1), ' '), '') END AS rf, CASE WHEN contains(n, '|') THEN nullif(trim(substr(n, position('|' IN n) + 1), ' '), '') END AS rt, CASE WHEN o_custkey % 3 = 0 THEN 'C' || o_custkey END AS od FROM r),
v AS (SELECT *, coalesce(rf, od, CAST(o_custkey AS VARCHAR)) AS origin, coalesce(CAST(city AS VARCHAR), rt, nullif(doc, ''), CAST(o_custkey + 7 AS VARCHAR)) AS destination, CASE WHEN m BETWEEN 0 AND 43200 THEN m WHEN q BETWEEN 0 AND 43200 THEN CAST(q AS BIGINT) END AS k FROM u)
SELECT trip, place, origin, destination, CASE WHEN rf IS NOT NULL THEN 'ROUTE' WHEN od IS NOT NULL THEN 'TRIP_DOC' ELSE 'TRIP_CITY' END AS origin_from, CASE WHEN city IS NOT NULL THEN 'STOP_CITY' WHEN rt IS NOT NULL THEN 'ROUTE' WHEN doc != '' THEN 'STOP_DOC' ELSE 'TRIP_CITY' END AS destination_from,
 origin || ' x ' || destination AS pair, CASE WHEN contains(origin, '/') THEN trim(split_part(origin, '/', 1)) WHEN contains(origin, '-') THEN trim(split_part(origin, '-', 1)) ELSE origin END AS origin_name, CASE WHEN contains(destination, '/') THEN trim(split_part(destination, '/', 1)) WHEN contains(destination, '-') THEN trim(split_part(destination, '-', 1)) ELSE destination END AS destination_name,
 place || 'º' AS place_label, strftime(ps, '%H:%M') AS cutoff, strftime(coalesce(pa, pe), '%H:%M') AS forecast, CASE WHEN k < 6000 THEN lpad(CAST(k // 60 AS VARCHAR), 2, '0') ELSE CAST(k // 60 AS VARCHAR) END || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') AS transit,
 CASE WHEN m BETWEEN 0 AND 43200 THEN 'DIRECT' WHEN q BETWEEN 0 AND 43200 THEN 'PREDICTED_DIFFERENCE' ELSE 'INVALID_OR_ABSENT' END AS transit_from, m IS NOT NULL AND m NOT BETWEEN 0 AND 43200 AS invalid_minutes, CASE WHEN x > ps THEN x ELSE ps END AS extracted FROM v""")
def mart_transit(t):
    """Trips with removed ones, removed stops, route texts of all kinds, minutes stated within and out of bounds."""
    trips = _expr(
        t("orders"), trip="o_orderkey", route="case o_orderkey % 6 when 0 then 'CITY A/SP/BRASIL ATE TOWN-B' when 1 then null when 2 then ' ATE X' when 3 then 'ONLY' when 4 then 'A-1 ATE B/2 ATE C' else ' ' end",
        origin_doc="if(o_custkey % 3 = 0, concat('C', o_custkey), ' ')", destination_doc="''", origin_city="o_custkey", destination_city="o_custkey + 7", planned_start="o_orderdate", planned_end="o_orderdate + make_dt_interval(0, 0, cast(o_orderkey * 41 % 50000 - 60 as int))",
        minutes="if(o_orderkey % 4 = 0, o_orderkey * 37 % 60000 - 100, null)", extracted="o_orderdate", removed="if(o_orderkey % 21 = 0, true, null)",
    )
    stops = _expr(t("lineitem").filter("l_linenumber > 1"), trip="l_orderkey", place="l_linenumber", city="if(l_linenumber % 3 = 0, 1000 + l_suppkey, null)", doc="if(l_linenumber % 2 = 0, '', concat('D', l_suppkey))", planned_arrival="if(l_linenumber % 2 = 1, l_shipdate + make_dt_interval(0, 0, 90), null)", extracted="l_shipdate", removed="l_partkey % 10 = 0")
    return M.transit(trips, stops)


_FREIGHTS = """f AS (SELECT o_orderkey AS freight, o_custkey AS payer, CASE o_orderkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 0.01 WHEN 2 THEN 0.01000001 WHEN 3 THEN NULL WHEN 4 THEN -5 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total, o_orderkey % 3 != 0 AS doc, CAST(o_orderdate AS DATE) AS issued FROM orders),
l AS (SELECT l_orderkey AS freight, count(DISTINCT l_linenumber) AS n, max(CAST(l_shipdate AS DATE)) AS due FROM lineitem WHERE l_linenumber IN (2, 5) GROUP BY 1),
g AS (SELECT f.*, n, CASE WHEN f.freight % 4 = 1 THEN NULL ELSE issued + 30 END AS own, CASE WHEN f.freight % 4 != 1 THEN issued + 30 WHEN n = 1 THEN l.due END AS due, CASE WHEN f.freight % 5 = 0 THEN NULL ELSE issued + 28 + CAST(f.freight % 5 AS INTEGER) END AS finished, coalesce(total, 0) > 0.01 AS worth FROM f LEFT JOIN l ON l.freight = f.freight),
h AS (SELECT *, CASE WHEN freight % 29 = 0 THEN 'INACTIVE' WHEN freight % 31 = 0 THEN 'CANCELLED' WHEN freight % 37 = 0 THEN 'COURTESY' WHEN freight % 41 = 0 THEN 'COMPLEMENTARY' WHEN NOT doc AND (NOT worth OR freight % 9 = 0 OR payer % 8 = 0) THEN 'INELIGIBLE' END AS why FROM g),
i AS (SELECT freight, 'PE' AS indicator, due AS reference_date, coalesce(why, CASE WHEN own IS NULL AND n > 1 THEN 'LOCATION_CONFLICT' WHEN due IS NULL THEN 'DATE_MISSING' WHEN payer % 10 = 3 THEN 'BRANCH_MISSING' END) AS reason, CASE WHEN finished IS NULL THEN 0 WHEN finished <= due THEN 1 WHEN finished > due THEN 2 END AS code, NULL AS cubed, CASE WHEN own IS NOT NULL THEN 'FREIGHT' WHEN n = 1 THEN 'LOCATION' END AS forecast_from FROM h
UNION ALL SELECT freight, 'CB', issued, coalesce(why, CASE WHEN payer % 20 = 7 THEN 'PAYER_EXCLUDED' WHEN NOT worth THEN 'VALUE_THRESHOLD' END), NULL, freight % 6 != 0, NULL FROM h)"""


def _indicators(t):
    freights = _expr(
        t("orders"), freight="o_orderkey", payer="o_custkey", total="cast(case o_orderkey % 7 when 0 then 0 when 1 then 0.01 when 2 then 0.01000001 when 3 then null when 4 then -5 else cast(o_totalprice as decimal(18,2)) end as decimal(28,8))", document="if(o_orderkey % 3 != 0, 'cte', null)",
        pending_substitute="o_orderkey % 9 = 0", branch_payer="o_custkey % 8 = 0", courtesy="o_orderkey % 37 = 0", active="o_orderkey % 29 != 0", cancelled="o_orderkey % 31 = 0", complementary="if(o_orderkey % 41 = 0, true, null)", issued="to_date(o_orderdate)",
        forecast="if(o_orderkey % 4 = 1, null, date_add(to_date(o_orderdate), 30))", finished="if(o_orderkey % 5 = 0, null, date_add(to_date(o_orderdate), cast(28 + o_orderkey % 5 as int)))", branch="if(o_custkey % 10 = 3, null, 'B')", volume="o_orderkey % 6 - 0.0",
    )
    locations = _expr(t("lineitem").filter("l_linenumber in (2, 5)"), freight="l_orderkey", location="l_linenumber", forecast="to_date(l_shipdate)")
    return M.freight_indicators(freights, locations.unionByName(locations), _expr(t("customer").filter("c_custkey % 20 = 7"), payer="c_custkey"))


@query(f"WITH {_FREIGHTS} SELECT freight, indicator, reference_date, reason IS NULL AS valid, reason, CAST(code AS INTEGER) AS code, CASE code WHEN 0 THEN 'EM ABERTO' WHEN 1 THEN 'NO PRAZO' WHEN 2 THEN 'FORA DO PRAZO' END AS state, cubed, forecast_from FROM i")
def mart_indicator_rows(t):
    """Delivery and cubage of each freight: thresholds of the value, missing documents and forecasts, one and two locations, excluded payers."""
    return _indicators(t)


@query(f"""WITH {_FREIGHTS} SELECT 'date' AS rule, 0 AS broken UNION ALL SELECT 'cubage', count(*) FILTER (indicator = 'CB' AND reason IS NULL AND freight % 7 IN (0, 1, 3, 4)) FROM i UNION ALL SELECT 'late', count(*) FILTER (code = 2) FROM i""")
def mart_indicator_invariants(t):
    """A valid row has a date, a valid cubage a value; how many deliveries are late."""
    i = _indicators(t)
    low = F.col("freight") % 7
    return Q.invariants(i, {"date": ~F.col("valid") | F.col("reference_date").isNotNull(), "cubage": ~((F.col("indicator") == "CB") & F.col("valid") & low.isin(0, 1, 3, 4)), "late": F.coalesce(F.col("code") != 2, F.lit(True))})


_REVENUE = """l AS (SELECT l_orderkey AS freight, l_orderkey * 1000000000 + l_partkey * 10 + l_linenumber AS line, l_suppkey AS invoice, l_partkey % 3 AS document, l_partkey % 53 = 0 AS conflict, l_partkey % 47 = 0 AS unresolved, CASE WHEN l_linenumber % 2 = 0 THEN 'cte' END AS cte, CASE WHEN l_partkey % 43 = 0 THEN 'CT-e Cancelado' WHEN l_partkey % 41 = 0 THEN 'CANCÉLLED' ELSE 'ok' END AS fiscal FROM lineitem WHERE l_partkey % 9 != 0),
p AS (SELECT freight, count(DISTINCT invoice) AS invoices, count(DISTINCT (invoice, document)) AS documents, bool_or(conflict) AS conflict, bool_or(unresolved) AS unresolved, bool_or(cte IS NOT NULL) AS cte, bool_or(fiscal != 'ok') AS cancelled FROM l GROUP BY 1),
g AS (SELECT l_orderkey AS freight, count(DISTINCT l_partkey * 10 + l_linenumber) AS n, min(l_suppkey) AS volumes FROM lineitem WHERE l_linenumber = 4 OR l_linenumber = 6 AND l_partkey % 4 = 0 GROUP BY 1),
r AS (SELECT o_orderkey AS k, o_custkey % 25 AS payer, CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(28,8)) END AS value, CASE WHEN o_orderkey % 17 = 0 THEN 'canceled' ELSE 'done' END AS status, o_orderkey % 59 != 0 AS valid, o_orderkey % 23 != 0 AS terms, o_orderkey % 67 = 0 AS clash, CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
 o_orderkey % 29 = 0 AS block, CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE o_orderkey % 31 = 0 END AS courtesy, o_orderkey % 19 != 0 AS eligible, o_orderkey % 37 != 0 AS active, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 50 END AS volumes FROM orders),
j AS (SELECT r.*, CASE WHEN terms THEN r.day END AS tday, invoices, documents, conflict, unresolved, coalesce(cte, false) AND status = 'canceled' AS by_status, coalesce(cancelled, false) AS by_invoice, g.n AS places, CASE WHEN g.n = 1 THEN g.volumes END AS gv FROM r LEFT JOIN p ON p.freight = k LEFT JOIN g ON g.freight = k),
x AS (SELECT *, CASE WHEN tday IS NOT NULL AND dayofweek(tday) != 0 THEN tday + 1 END AS billing, CASE WHEN terms AND payer % 6 != 0 AND year(tday) BETWEEN 1995 AND 2000 THEN 'B' || payer END AS branch FROM j),
c AS (SELECT *, CASE WHEN NOT terms THEN 'TERMS_MISSING' WHEN clash OR NOT valid OR coalesce(conflict, false) THEN 'DATA_CONFLICT' WHEN coalesce(invoices, 0) = 0 THEN 'DEPENDENCY_MISSING' WHEN unresolved THEN 'FISCAL_UNRESOLVED' WHEN places > 1 THEN 'LOCATION_CONFLICT' WHEN tday IS NULL THEN 'NULL_DATE' WHEN NOT active THEN 'INACTIVE' WHEN by_status OR by_invoice THEN 'CANCELLED'
 WHEN courtesy THEN 'COURTESY' WHEN block THEN 'BILLING_BLOCK' WHEN courtesy IS NULL THEN 'POLICY_MISSING' WHEN NOT eligible THEN 'INELIGIBLE' WHEN billing IS NULL THEN 'REFERENCE_MISSING' WHEN branch IS NULL THEN 'PAYER_UNMAPPED' WHEN value IS NULL THEN 'VALUE_MISSING' ELSE 'READY' END AS s FROM x),
o AS (SELECT k AS freight, tday AS day, billing, branch, coalesce(gv, CASE WHEN terms THEN volumes END) AS volumes, CASE WHEN gv IS NOT NULL THEN 'LOCATION' WHEN terms AND volumes IS NOT NULL THEN 'TERMS' ELSE 'MISSING' END AS volumes_from, coalesce(invoices, 0) AS invoices, coalesce(documents, 0) AS documents, CASE WHEN by_status AND by_invoice THEN 'INVOICE_AND_FREIGHT' WHEN by_invoice THEN 'INVOICE' WHEN by_status THEN 'FREIGHT' ELSE 'NONE' END AS cancelled_from, s AS disposition,
 CAST(CASE WHEN NOT terms OR clash OR NOT valid THEN NULL WHEN tday IS NULL OR NOT active OR by_status OR by_invoice OR coalesce(courtesy, false) OR block OR NOT eligible THEN 0 WHEN s = 'READY' THEN value END AS DECIMAL(28,8)) AS revenue FROM c)"""


def _revenue(t):
    orders, l = t("orders"), t("lineitem")  # noqa: E741
    freights = _expr(orders, freight="o_orderkey", value="if(o_orderkey % 61 = 0, null, cast(o_totalprice as decimal(28,8)))", status="if(o_orderkey % 17 = 0, 'canceled', 'done')", valid="o_orderkey % 59 != 0")
    terms = _expr(
        orders.filter("o_orderkey % 23 != 0"), freight="o_orderkey", state="if(o_orderkey % 67 = 0, 'CONFLICT', 'READY')", day="if(o_orderkey % 71 = 0, null, to_date(o_orderdate))", classification="if(o_orderkey % 29 = 0, 'BLOQUEIO por Anulação', 'normal')",
        courtesy="if(o_orderkey % 73 = 0, null, o_orderkey % 31 = 0)", eligible="o_orderkey % 19 != 0", active="o_orderkey % 37 != 0", volumes="if(o_orderkey % 5 = 0, null, o_orderkey % 50)", payer="o_custkey % 25",
    )
    # invoices' lines and locations reach freights by resolved relations
    edge = dict(origin_component="'i'", target_component="'r'", target_date="cast(null as date)", revision="1")
    fat = _expr(l, kind="'FAT'", origin="l_orderkey * 1000000000 + l_partkey * 10 + l_linenumber", target="l_orderkey", cardinality="'MANY_TO_MANY'", **edge)
    loc = _expr(l.filter("l_linenumber = 4 or l_linenumber = 6 and l_partkey % 4 = 0"), kind="'LOC'", origin="l_orderkey * 1000000000 + l_partkey * 10 + l_linenumber", target="l_orderkey", cardinality="'ONE_TO_ONE'", **edge)
    lines = l.withColumn("line", F.expr("l_orderkey * 1000000000 + l_partkey * 10 + l_linenumber"))
    roots = _expr(lines.filter("l_partkey % 9 != 0"), entity="'line'", id="line").unionByName(_expr(lines, entity="'place'", id="line")).unionByName(_expr(orders, entity="'freight'", id="o_orderkey"))
    parts = _expr(roots.filter("entity != 'freight'"), entity="entity", id="id", component="'i'")
    ends = l.sparkSession.createDataFrame([("FAT", "line", "freight", "r"), ("LOC", "place", "freight", "r")], "kind string, origin_entity string, target_entity string, root_target string")
    found = R.resolve_relations(fat.unionByName(loc), roots, parts, ends).select("kind", F.col("origin").alias("line"), F.col("target").alias("freight"), "disposition")
    facts = _expr(lines, line="line", invoice="l_suppkey", document="l_partkey % 3", conflict="l_partkey % 53 = 0", unresolved="l_partkey % 47 = 0", cte="if(l_linenumber % 2 = 0, 'cte', null)", fiscal="case when l_partkey % 43 = 0 then 'CT-e Cancelado' when l_partkey % 41 = 0 then 'CANCÉLLED' else 'ok' end")
    invoiced = storage.written(found.filter("kind = 'FAT' and disposition = 'RESOLVED'").select("line", "freight").join(facts, "line").drop("line"), "revenue-lines", free=True)
    places = found.filter("kind = 'LOC'").join(_expr(lines, line="line", volumes="l_suppkey"), "line").select("freight", F.col("line").alias("location"), "volumes", F.lit(True).alias("valid"))
    days = _expr(orders, day="to_date(o_orderdate)").distinct().filter("dayofweek(day) != 1").withColumn("billing", F.date_add("day", 1))
    assigned = _expr(t("nation").filter("n_nationkey % 6 != 0"), payer="cast(n_nationkey as bigint)", branch="concat('B', n_nationkey)", lo="date'1995-01-01'", hi="date'2001-01-01'")
    return M.revenue(freights, terms, invoiced, places, days, assigned)


@query(f"WITH {_REVENUE} SELECT * FROM o")
def mart_revenue_facts(t):
    """All dispositions, over relations that are resolved or in conflict."""
    return _revenue(t)


@query(f"WITH {_REVENUE}, b AS (SELECT *, CASE WHEN freight % 10 = 0 THEN 'INSERT' WHEN freight % 10 = 1 AND revenue IS NOT NULL THEN 'UPDATE' ELSE 'NOOP' END AS action FROM o) SELECT count(*) AS candidates, count(*) FILTER (action = 'INSERT') AS inserts, count(*) FILTER (action = 'UPDATE') AS updates, count(*) FILTER (action = 'NOOP') AS noops, count(*) FILTER (disposition = 'READY') AS ready, count(*) FILTER (disposition != 'READY') AS blocked FROM b")
def mart_revenue_receipt(t):
    """What a second materialisation would write after some rows were lost and some amounts cleared."""
    now = storage.written(_revenue(t), "revenue-facts")
    stored = now.filter("freight % 10 != 0").withColumn("revenue", F.when(F.col("freight") % 10 != 1, F.col("revenue")))
    return M.materialized(now, stored, "freight")[1]


_ALIAS = "CASE WHEN strip_accents(lower({0})) IN ('ag 1', 'branch 1') THEN 'AG1' WHEN strip_accents(lower({0})) IN ('sao 2', '2') THEN 'SP2' END"


@query(f"""WITH m AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS day, CASE o_orderkey % 4 WHEN 0 THEN 'ÁG 1' WHEN 1 THEN ' são 2 ' WHEN 2 THEN ' ' ELSE 'Other' END AS branch, CASE o_orderkey % 5 WHEN 0 THEN '["Zed; AG 1"]' WHEN 1 THEN 'null' WHEN 2 THEN NULL WHEN 3 THEN '["SAO 2", "Mid"]' ELSE 'Solo' END AS dest, o_orderdate, o_orderkey FROM orders WHERE o_orderkey % 6 NOT IN (1, 2)),
n AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC, o_orderkey DESC) = 1), u AS (SELECT k, day, trim(unnest(string_split(translate(translate(dest, '[]"', ''), ';', ','), ',')), ' ') AS p FROM n),
d AS (SELECT k, day, min(coalesce({_ALIAS.format("p")}, p)) AS branch FROM u WHERE p != '' AND lower(p) != 'null' GROUP BY 1, 2),
fr AS (SELECT l_orderkey AS freight, max(CASE WHEN l_suppkey % 2 = 0 THEN 'Branch 1' ELSE '' END) FILTER (l_linenumber = mx) AS b FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS mx FROM lineitem) GROUP BY 1),
od AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 = 0 THEN 'sáo 2' WHEN event_id % 3 = 1 THEN '' END AS b, event_type, value < 20 AS open, event_id FROM events WHERE event_type IN ('view', 'click') QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id DESC) = 1),
og AS (SELECT od.day, coalesce(nullif(trim(od.b), ''), nullif(trim(fr.b), '')) AS nm, open FROM od LEFT JOIN fr ON fr.freight = od.user_id),
c AS (SELECT day, coalesce({_ALIAS.format("trim(branch)")}, nullif(trim(branch), ''), 'unknown') AS branch, 0 AS scanned, 1 AS issued, 0 AS unloaded, 0 AS left_open FROM n UNION ALL SELECT day, branch, 0, 0, 1, 0 FROM d UNION ALL SELECT day, coalesce({_ALIAS.format("nm")}, nm, 'unknown'), 1, 0, 0, CAST(open AS INTEGER) FROM og),
a AS (SELECT day, branch, CAST(sum(scanned) AS BIGINT) AS scanned, CAST(sum(issued) AS BIGINT) AS issued, CAST(sum(unloaded) AS BIGINT) AS unloaded, CAST(sum(left_open) AS BIGINT) AS left_open FROM c GROUP BY 1, 2)
SELECT day, year(day) * 100 + month(day) AS month, branch, scanned, issued, unloaded, issued + unloaded AS manifests, left_open, CASE WHEN issued + unloaded = 0 THEN 0 ELSE round(scanned * 100.0 / (issued + unloaded), 4) END AS percent, scanned > 0 AS has_orders, issued + unloaded > 0 AS has_manifests,
 sha256(strlen(CAST(day AS VARCHAR)) || ':' || day || strlen(branch) || ':' || branch || strlen(CAST(scanned AS VARCHAR)) || ':' || scanned || strlen(CAST(issued AS VARCHAR)) || ':' || issued || strlen(CAST(unloaded AS VARCHAR)) || ':' || unloaded || strlen(CAST(left_open AS VARCHAR)) || ':' || left_open) AS row_hash FROM a""")
def mart_collectors(t):
    """Branches by aliases with accents, destinations as lists and texts, closed classes, orders whose branch comes from the freight."""
    manifests = _expr(
        t("orders"), manifest="o_custkey", day="to_date(o_orderdate)", branch="case o_orderkey % 4 when 0 then 'ÁG 1' when 1 then ' são 2 ' when 2 then ' ' else 'Other' end", destinations="""case o_orderkey % 5 when 0 then '["Zed; AG 1"]' when 1 then 'null' when 2 then null when 3 then '["SAO 2", "Mid"]' else 'Solo' end""",
        stored="o_orderdate", ordinal="o_orderkey", **{"class": "case o_orderkey % 6 when 1 then ' Carga Fechada x' when 2 then 'VIAGEM VAZIA' when 3 then null else 'run' end"},
    )
    orders = _expr(t("events"), ordering="concat(user_id, event_type, to_date(ts))", day="to_date(ts)", branch="case event_id % 3 when 0 then 'sáo 2' when 1 then '' end", freight="user_id", kind="event_type", ended="if(value < 20, null, ts)", updated="event_id", item="event_id")
    freights = _expr(t("lineitem"), freight="l_orderkey", branch="if(l_suppkey % 2 = 0, 'Branch 1', '')", stored="l_linenumber")
    aliases = t("orders").sparkSession.createDataFrame([(["AG 1", "BRANCH 1"], "AG1"), (["Sao 2", "2"], "SP2")], "names array<string>, branch string")
    out = M.collectors(manifests, orders, freights, aliases, ["carga fechada", "viagem vazia"], ["VIEW", "click"])
    return out.withColumn("month", F.col("month").cast("long"))


@query("""WITH i AS (SELECT event_id, user_id AS ordering, CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id * 7 END AS freight, '2024-01-0' || (1 + user_id % 3) || ' 08:30:00' AS started, ts, event_type, CASE WHEN event_id % 90 = 5 THEN 'O COMPROVANTE de Entrega foi anexádo' WHEN event_id % 90 = 6 THEN 'entrega comprovante anexado' END AS description FROM events),
l AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY ordering ORDER BY CASE WHEN event_type = 'purchase' THEN ts ELSE CAST(started AS TIMESTAMP) END DESC, event_id DESC) = 1), p AS (SELECT ordering, bool_or(coalesce(description LIKE 'O COMP%', false)) AS proof FROM i GROUP BY 1),
b AS (SELECT l_orderkey AS freight, CASE WHEN count(DISTINCT br) = 1 THEN min(br) END AS br FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'F' || l_suppkey % 2 END AS br FROM lineitem) GROUP BY 1)
SELECT sha256(l.ordering || '|' || coalesce(CAST(l.freight AS VARCHAR), 'null') || '|' || CASE WHEN l.ordering % 5 = 0 THEN '' ELSE 'n' || l.ordering || ', n0' END || '|' || started) AS item, l.ordering, l.freight, '08:30:00' AS clock, CASE event_type WHEN 'view' THEN 'Loading' WHEN 'click' THEN 'Picking' ELSE event_type END AS kind, CASE WHEN event_id % 2 = 0 THEN 'done' ELSE 'odd' END AS state,
 'own' || l.ordering % 3 AS branch, coalesce(br, 'own' || l.ordering % 3) AS issuing_branch, CASE WHEN l.ordering % 5 != 0 THEN 'n' || l.ordering || ', n0' END AS invoices, proof FROM l JOIN p USING (ordering) LEFT JOIN b ON b.freight = l.freight""")
def mart_inventory_orders(t):
    """Items with null freights and lists, a proof in an earlier row, its words in another order, freights of one and of two branches."""
    items = _expr(
        t("events"), ordering="user_id", freight="if(user_id % 4 = 0, null, user_id * 7)", invoices="""if(user_id % 5 = 0, null, array(concat('n', user_id), '"n0"'))""", started="cast(concat('2024-01-0', 1 + user_id % 3, ' 08:30:00') as timestamp_ntz)", finished="cast(null as timestamp_ntz)", performed="if(event_type = 'purchase', ts, null)",
        kind="event_type", state="if(event_id % 2 = 0, 'finished', 'odd')", branch="concat('own', user_id % 3)", description="case event_id % 90 when 5 then 'O COMPROVANTE de Entrega foi anexádo' when 6 then 'entrega comprovante anexado' end", stored="event_id", ordinal="event_id",
    )
    freights = _expr(t("lineitem"), freight="l_orderkey", branch="if(l_linenumber % 3 = 0, null, concat('F', l_suppkey % 2))")
    return M.inventory_orders(items, freights, {"view": "Loading", "click": "Picking"}, {"finished": "done"})


@query("""WITH e AS (SELECT *, user_id * 10 + event_id % 4 AS pickup FROM events), a AS (SELECT pickup, ts AS updated, event_type AS status, event_id, user_id FROM e WHERE event_type != 'error' QUALIFY row_number() OVER (PARTITION BY pickup ORDER BY ts DESC, event_id DESC) = 1),
d AS (SELECT pickup, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) + INTERVAL 30 DAY ELSE ts END AS off, event_id AS id FROM e WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY pickup ORDER BY off DESC, event_id DESC) = 1), j AS (SELECT coalesce(a.pickup, d.pickup) AS pickup, a.* EXCLUDE pickup, d.off, d.id, d.id IS NOT NULL AND (updated IS NULL OR off >= updated) AS x FROM a FULL JOIN d ON a.pickup = d.pickup)
SELECT pickup, CASE WHEN x THEN 'DELETED' WHEN status = 'view' THEN 'Seen' WHEN status = 'purchase' THEN 'Taken' ELSE status END AS status, x AS removed, x OR coalesce(status = 'purchase', false) AS terminal, CASE WHEN event_id IS NULL THEN '00:00:00' WHEN event_id % 3 = 0 THEN strftime(updated, '%H:%M:%S') WHEN event_id % 3 = 1 THEN strftime(updated, '%H:%M') || ':00' ELSE '00:00:00' END AS clock,
 CASE WHEN event_id IS NULL THEN '' WHEN event_id % 5 = 0 THEN 'sp' ELSE 'C' || user_id || CASE WHEN event_id % 4 = 0 THEN '' ELSE ' - sp' END END AS region, CASE WHEN event_id IS NULL OR event_id % 5 = 0 THEN 'no city' ELSE 'C' || user_id END || ' - ' || CASE WHEN event_id IS NULL OR event_id % 4 = 0 AND event_id % 5 != 0 THEN 'no state' ELSE 'SP' END AS logistic_region,
 CASE WHEN event_id % 3 != 0 THEN event_id ELSE id END AS weight, CASE WHEN x AND id % 2 = 0 THEN 'D' || id ELSE 'A' || event_id END AS branch, CASE WHEN x THEN 'r' || id END AS reason, CASE WHEN x THEN off END AS removed_at FROM j""")
def mart_pickup_rows(t):
    """Deletions before, at and after the row's last change, pickups of one side alone, unknown states, missing parts of the address."""
    e = t("events").withColumn("pickup", F.col("user_id") * 10 + F.col("event_id") % 4)
    live = _expr(
        e.filter("event_type != 'error'"), pickup="pickup", updated="ts", status="if(event_type = 'view', ' VIEW ', event_type)", hour="case event_id % 3 when 0 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") when 1 then date_format(ts, 'HH:mm') else 'none' end", city="if(event_id % 5 = 0, ' ', concat('C', user_id))",
        state="if(event_id % 4 = 0 and event_id % 5 != 0, null, 'sp')", branch="concat('A', event_id)", weight="if(event_id % 3 != 0, event_id, null)", stored="event_id",
    )
    gone = _expr(e.filter("event_type = 'error'"), pickup="pickup", deleted_at="if(event_id % 2 = 0, cast(date_add(to_date(ts), 30) as timestamp_ntz), ts)", branch="if(event_id % 2 = 0, concat('D', event_id), null)", weight="event_id", reason="concat('r', event_id)", stored="event_id")
    catalog = e.sparkSession.createDataFrame([("view", "Seen", False), ("purchase", "Taken", True)], "code string, label string, terminal boolean")
    return M.pickups(live, gone, catalog)


@query("""WITH n AS (SELECT 'S' || n_nationkey AS o, 'S' || n_regionkey AS d, CAST(n_nationkey + 0.5 AS DECIMAL(19,4)) AS amount FROM nation), q AS (SELECT *, o_orderkey AS k, 'C' || o_custkey || ' - S' || o_custkey % 25 AS a, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'D' || o_orderkey % 9 END || ' - S' || o_orderkey % 5 AS b FROM orders)
SELECT 'Q' || k AS number, o_orderdate AS requested, strftime(o_orderdate, '%H:%M:%S') AS clock, 'B' || k % 3 AS branch, CASE WHEN k % 4 != 0 THEN 'user ' || k % 10 END AS user_key, CASE WHEN k % 5 = 0 THEN 'Nick' ELSE 'Customer ' || o_custkey END AS customer, a AS origin, b AS destination, a || ' x ' || b AS leg,
 CAST(k % 100 AS INTEGER) AS volumes, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS DECIMAL(18,3)) AS taxed_weight, CAST(o_totalprice AS DECIMAL(18,2)) AS invoices_value, CASE WHEN k % 11 != 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total, coalesce(amount, 0) AS tariff,
 CASE WHEN k % 3 = 0 OR k % 13 = 0 THEN 'Converted' WHEN k % 3 = 1 AND k % 2 = 0 THEN 'Rejected' ELSE 'Pending' END AS status, CASE WHEN k % 3 = 0 THEN 'Issued' ELSE 'Pending' END AS cte_state, CASE WHEN k % 13 = 0 THEN 'Issued' ELSE 'Pending' END AS nfse_state FROM q LEFT JOIN n ON n.o = 'S' || o_custkey % 25 AND n.d = 'S' || k % 5""")
def mart_quote_rows(t):
    """Quotes of captured envelopes: converted by either document, rejected by a comment (a blank one is none), amounts that aren't numbers."""
    record = t("orders").select(F.struct(*[F.expr(e).alias(c) for c, e in {
        "number": "concat('Q', o_orderkey)", "requested": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")", "branch": "concat('B', o_orderkey % 3)", "user": "if(o_orderkey % 4 = 0, ' ', concat(' User ', o_orderkey % 10))", "customer": "concat('Customer ', o_custkey)", "nickname": "if(o_orderkey % 5 = 0, 'Nick', null)",
        "origin_city": "concat('C', o_custkey)", "origin_state": "concat('S', o_custkey % 25)", "destination_city": "if(o_orderkey % 7 = 0, null, concat('D', o_orderkey % 9))", "destination_state": "concat('S', o_orderkey % 5)", "volumes": "o_orderkey % 100", "taxed_weight": "cast(cast(o_totalprice as decimal(18,2)) * 2 as decimal(18,3))",
        "invoices_value": "cast(o_totalprice as decimal(18,2))", "total": "if(o_orderkey % 11 = 0, 'n/a', cast(cast(o_totalprice as decimal(18,2)) as string))", "comments": "case when o_orderkey % 3 = 1 and o_orderkey % 2 = 0 then 'too dear' when o_orderkey % 3 = 1 then '  ' end",
        "cte_at": "if(o_orderkey % 3 = 0, '2024-01-01T00:00:00', null)", "nfse_at": "if(o_orderkey % 13 = 0, '2024-01-01T00:00:00', null)",
    }.items()]).alias("record"))
    captures = record.select(F.to_json(F.struct(F.lit("quote").alias("entity"), "record")).alias("envelope"))
    tariffs = _expr(t("nation"), origin="concat('S', n_nationkey)", destination="concat('S', n_regionkey)", amount="cast(n_nationkey + 0.5 as decimal(19,4))")
    return M.quote_rows(captures, tariffs)


@query("""SELECT event_id AS number, CASE WHEN event_id % 3 != 0 THEN user_id END AS invoice, CASE WHEN event_id % 5 != 0 THEN user_id + 1 END AS freight, sha256(event_id || '|' || CASE WHEN event_id % 3 != 0 THEN CAST(user_id AS VARCHAR) ELSE 'null' END || '|' || CASE WHEN event_id % 5 != 0 THEN CAST(user_id + 1 AS VARCHAR) ELSE 'null' END) AS claim, ts AS opened,
 CASE event_id % 7 WHEN 0 THEN strftime(ts, '%H:%M:%S') WHEN 1 THEN strftime(ts, '%H:%M') WHEN 2 THEN 'noon' WHEN 3 THEN strftime(ts, '%H:%M:%S') END AS occurred_clock, CASE event_id % 7 WHEN 0 THEN '99:99' WHEN 1 THEN 'x' END AS closed_clock, CAST(value AS DECIMAL(18,3)) AS weight,
 CAST(CAST(value AS DECIMAL(18,2)) - CASE WHEN event_id % 2 = 0 THEN 10 ELSE 0 END AS DECIMAL(18,2)) AS result, CASE event_type WHEN 'view' THEN 'Seen' ELSE event_type END AS treatment, CASE WHEN event_id % 4 = 0 THEN 'Sent again' ELSE 'other' END AS solution FROM events WHERE event_id % 50 != 9""")
def mart_claim_rows(t):
    """Claims without invoice or freight, clock times in all kinds of texts, labels with unknown codes."""
    rows = _expr(
        t("events"), number="if(event_id % 50 = 9, null, event_id)", invoice="if(event_id % 3 != 0, user_id, null)", freight="if(event_id % 5 != 0, user_id + 1, null)", opened="ts",
        occurred_clock="case event_id % 7 when 0 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") when 1 then concat(' ', date_format(ts, 'HH:mm'), 'h') when 2 then 'noon' when 3 then date_format(ts, 'HH:mm:ss.SSS') when 4 then '2024-01-01' when 5 then 'NULL' else 'some time after noon' end",
        closed_clock="case event_id % 7 when 0 then '2024-01-01 99:99' when 1 then ' x ' when 2 then ' ' end", weight="cast(value as decimal(18,3))", debit="if(event_id % 2 = 0, 10, null)", credit="cast(value as decimal(18,2))", insurer_credit="cast(null as decimal(18,2))", treatment="event_type", solution="if(event_id % 4 = 0, 'again', 'other')",
    )
    return M.claim_rows(rows, {"view": "Seen"}, {"again": "Sent again"})


@query("""WITH p AS (SELECT o_custkey AS entry, o_orderkey AS k, o_orderdate AS created, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS settled, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 2 END AS transacted, o_totalprice, o_orderpriority FROM orders),
l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY entry ORDER BY greatest(created, settled + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND, transacted + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND) DESC, k DESC) = 1)
SELECT entry, strftime(created, '%H:%M:%S') AS clock, CASE WHEN k % 2 = 0 THEN 'Advance payment' WHEN k % 5 = 0 THEN NULL ELSE 'Odd' END AS kind, CASE o_orderpriority WHEN '1-URGENT' THEN '1. Revenue' ELSE o_orderpriority END AS class, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CASE WHEN k % 6 != 0 THEN CAST(-1.5 AS DECIMAL(18,2)) END AS interest,
 CASE WHEN k % 3 = 0 THEN 'PAID' ELSE 'OPEN' END AS state, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 2 = 0 THEN 'RECONCILED' ELSE 'UNRECONCILED' END AS reconciled, settled, transacted FROM l""")
def mart_payable_rows(t):
    """Entries by the latest of three times, types with and without a namespace, amounts as money texts, broken and blank ones."""
    rows = _expr(
        t("orders"), entry="o_custkey", created="o_orderdate", settled="if(o_orderkey % 3 = 0, to_date(o_orderdate), null)", transacted="if(o_orderkey % 4 = 0, date_add(to_date(o_orderdate), 2), null)", stored="o_orderkey", ordinal="o_orderkey", kind="case when o_orderkey % 2 = 0 then 'Fin::Entry:: Advance' when o_orderkey % 5 = 0 then ' ' else 'Odd' end",
        amount="concat('R$ ', format_number(cast(o_totalprice as decimal(18,2)), 2))", interest="if(o_orderkey % 6 = 0, if(o_orderkey % 12 = 0, 'x', ' '), '-1.5')", paid="if(o_orderkey % 3 = 0, true, null)", reconciled="if(o_orderkey % 7 = 0, null, o_orderkey % 2 = 0)", **{"class": "o_orderpriority"},
    )
    return M.payable_rows(rows, ["amount", "interest"], {"Advance": "Advance payment"}, {"1-URGENT": "1. Revenue"})


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), h AS (SELECT *, CASE WHEN strftime(day, '%m%d') IN ('0101', '1225') THEN 'fixed' WHEN strftime(day, '%Y%m%d') IN ('19950416', '19960407', '19970330', '19980412', '19990404', '20000423', '20010415') THEN 'easter' WHEN strftime(day + 47, '%Y%m%d') IN ('19950416', '19960407', '19970330', '19980412', '19990404', '20000423', '20010415') THEN 'carnival'
 WHEN strftime(day + 2, '%Y%m%d') IN ('19950416', '19960407', '19970330', '19980412', '19990404', '20000423', '20010415') THEN 'good friday' WHEN strftime(day - 60, '%Y%m%d') IN ('19950416', '19960407', '19970330', '19980412', '19990404', '20000423', '20010415') THEN 'corpus christi' END AS holiday FROM d), b AS (SELECT *, holiday IS NULL AND isodow(day) < 6 AS business FROM h WHERE year(day) BETWEEN 1995 AND 2001),
c AS (SELECT *, coalesce(max(CASE WHEN business THEN day END) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING), day) AS billing FROM b)
SELECT day, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS day_key, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS dom, CAST(quarter(day) AS INTEGER) AS quarter, CAST(weekofyear(day) AS INTEGER) AS iso_week, CAST(isodow(day) AS INTEGER) AS iso_weekday, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][isodow(day)] AS weekday, isodow(day) > 5 AS weekend,
 CASE WHEN holiday NOT IN ('carnival', 'corpus christi') THEN holiday END AS national_holiday, CASE WHEN holiday IN ('carnival', 'corpus christi') THEN holiday END AS optional_day, business, billing AS billing_day, CAST(strftime(billing, '%Y%m%d') AS INTEGER) AS billing_key, CAST(year(day) * 100 + month(day) AS INTEGER) AS year_month FROM c""")
def mart_calendar_names(t):
    """Names and keys of the calendar's days; Easter's dates stand in the SQL as they are."""
    days = t("orders").select(F.to_date("o_orderdate").alias("day")).distinct().filter("year(day) between 1995 and 2001")
    fixed = days.sparkSession.createDataFrame([(1, 1), (12, 25)], "month int, dom int")
    return M.calendar_names(calendar(days, fixed), ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"], ["carnival", "corpus christi"])
