"""Queries that prove reconciliation on the supplied tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from graylane.operators import quality as Q
from graylane.registry import query


@query("""WITH a AS (SELECT p_brand, p_type, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part), b AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'X' ELSE p_brand END AS p_brand, p_type, CAST(p_retailprice + CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price FROM part WHERE p_partkey % 10 != 0),
s AS (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b), t AS (SELECT sum(s) AS n FROM s GROUP BY p_brand, p_type, price),
g AS (SELECT m, sum(s) AS n FROM (SELECT 'bag:p_brand' AS m, p_brand AS v, s FROM s UNION ALL SELECT 'bag:p_type', p_type, s FROM s UNION ALL SELECT 'bag:price', CAST(price AS VARCHAR), s FROM s) GROUP BY m, v),
r AS (SELECT 'rows' AS measure, (SELECT count(*) FROM a) AS l, (SELECT count(*) FROM b) AS r UNION ALL SELECT 'tuples', sum(greatest(n, 0)), sum(greatest(-n, 0)) FROM t UNION ALL SELECT m, sum(greatest(n, 0)), sum(greatest(-n, 0)) FROM g GROUP BY m UNION ALL SELECT 'total:price', (SELECT sum(price) FROM a), (SELECT sum(price) FROM b))
SELECT measure, CAST(l AS DECIMAL(38,2)) AS left, CAST(r AS DECIMAL(38,2)) AS right, CASE WHEN measure LIKE 'bag:%' OR measure = 'tuples' THEN l = 0 AND r = 0 ELSE l = r END AS equal FROM r""")
def compare_exports(t):
    p = t("part")
    a = p.select("p_brand", "p_type", F.col("p_retailprice").cast("decimal(18,2)").alias("price"))
    price = (F.col("p_retailprice") + F.when(F.col("p_partkey") % 8 == 0, 1).otherwise(0)).cast("decimal(18,2)")
    b = p.filter("p_partkey % 10 != 0").select(F.when(F.col("p_partkey") % 9 == 0, "X").otherwise(F.col("p_brand")).alias("p_brand"), "p_type", price.alias("price"))
    return Q.compare_exports(a, b, ["p_brand", "p_type", "price"], ["price"])


@query("SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_quantity)) AS distinct_rows, true AS same_shuffled, true AS other_edited FROM lineitem")
def bag_digest(t):
    """The digest is the same after a shuffle and another after one row was edited."""
    l = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")  # noqa: E741
    last = l.agg(F.max("l_orderkey")).first()[0]
    a, b, c = Q.bag_digest(l), Q.bag_digest(l.repartition(5)), Q.bag_digest(l.withColumn("l_partkey", F.col("l_partkey") + F.when(F.col("l_orderkey") == last, 1).otherwise(0)))
    one = lambda df, n: df.select(F.col("digest").alias(n))
    j = a.join(one(b, "shuffled"), how="cross").join(one(c, "edited"), how="cross")
    return j.select("rows", "distinct_rows", (F.col("digest") == F.col("shuffled")).alias("same_shuffled"), (F.col("digest") != F.col("edited")).alias("other_edited"))


@query("""WITH e AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 50 != 0),
o AS (SELECT o_orderkey, CAST(CAST(o_totalprice + CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS VARCHAR) AS p, CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 40 != 0),
j AS (SELECT coalesce(e.o_orderkey, o.o_orderkey) AS o_orderkey, e.o_orderkey AS ek, o.o_orderkey AS ok, e.p AS ep, o.p AS op, e.s AS es, o.s AS os FROM e FULL JOIN o USING (o_orderkey))
SELECT o_orderkey, '*' AS column, CASE WHEN ok IS NULL THEN 'MISSING' ELSE 'EXTRA' END AS kind, NULL AS expected, NULL AS observed FROM j WHERE ek IS NULL OR ok IS NULL
UNION ALL SELECT o_orderkey, 'p', 'VALUE', ep, op FROM j WHERE ep != op UNION ALL SELECT o_orderkey, 's', 'NULLABILITY', es, os FROM j WHERE ek IS NOT NULL AND ok IS NOT NULL AND os IS NULL""")
def row_diff(t):
    o, k = t("orders"), F.col("o_orderkey")
    e = o.filter("o_orderkey % 50 != 0").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("p"), F.col("o_orderstatus").alias("s"))
    price = (F.col("o_totalprice") + F.when(k % 20 == 0, 1).otherwise(0)).cast("decimal(18,2)")
    b = o.filter("o_orderkey % 40 != 0").select("o_orderkey", price.alias("p"), F.when(k % 30 != 0, F.col("o_orderstatus")).alias("s"))
    return Q.row_diff(e, b, "o_orderkey", ["p", "s"])


@query("""WITH e AS (SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 50 != 0),
o AS (SELECT o_orderkey AS k, CAST(CAST(o_totalprice + CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS VARCHAR) AS p, CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 40 != 0),
j AS (SELECT coalesce(e.k, o.k) AS k, e.k AS ek, o.k AS ok, e.p AS ep, o.p AS op, e.s AS es, o.s AS os FROM e FULL JOIN o USING (k)),
r AS (SELECT 'MISSING' AS kind, '*' AS c, k FROM j WHERE ok IS NULL UNION ALL SELECT 'EXTRA', '*', k FROM j WHERE ek IS NULL UNION ALL SELECT 'VALUE', 'p', k FROM j WHERE ep != op UNION ALL SELECT 'NULLABILITY', 's', k FROM j WHERE ek IS NOT NULL AND ok IS NOT NULL AND os IS NULL)
SELECT kind, c AS column, count(*) AS n, list_sort(list(k))[1:3] AS keys FROM r GROUP BY 1, 2 UNION ALL SELECT 'COLUMN', 'x', 1, [] UNION ALL SELECT 'TYPE', 'd', 1, [] UNION ALL SELECT 'CONTRACT', 'version', 1, [] UNION ALL SELECT 'METADATA', 'author', 1, [] UNION ALL SELECT 'ROW_COUNT', '*', abs((SELECT count(*) FROM e) - (SELECT count(*) FROM o)), [] WHERE (SELECT count(*) FROM e) != (SELECT count(*) FROM o)""")
def compare_tables(t):
    """As row_diff, with what differs in the tables themselves: a further column, a column of another type, the number of rows, another version of the contract, and an author that only one has."""
    o, k = t("orders").withColumn("d", F.to_date("o_orderdate")), F.col("o_orderkey")
    e = o.filter("o_orderkey % 50 != 0").select(k.alias("k"), F.col("o_totalprice").cast("decimal(18,2)").alias("p"), F.col("o_orderstatus").alias("s"), "d")
    price = (F.col("o_totalprice") + F.when(k % 20 == 0, 1).otherwise(0)).cast("decimal(18,2)")
    b = o.filter("o_orderkey % 40 != 0").select(k.alias("k"), price.alias("p"), F.when(k % 30 != 0, F.col("o_orderstatus")).alias("s"), F.col("d").cast("string").alias("d"), F.lit(1).alias("x"))
    return Q.compare_tables(e, b, "k", facts=({"version": "1", "entity": "orders", "author": "a"}, {"version": "2", "entity": "orders"}), metadata=["author"])


@query("""SELECT run, n, first_page FROM (SELECT event_id % 7 AS run, CAST(json_extract_string(props, '$.k') AS BIGINT) % 50 AS k, count(*) AS n, min(event_id) AS first_page FROM events GROUP BY 1, 2 HAVING count(*) > 1)""")
def repeated_objects(t):
    """Equal objects with their fields in either order and a running number that doesn't count."""
    v, i = (F.get_json_object("props", "$.k").cast("long") % 50).cast("string"), F.col("event_id").cast("string")
    a = F.concat(F.lit('{"k": '), v, F.lit(', "seq": '), i, F.lit(', "z": 1}'))
    b = F.concat(F.lit('{"z": 1, "seq": '), i, F.lit(', "k": '), v, F.lit("}"))
    e = t("events").select((F.col("event_id") % 7).alias("run"), "event_id", F.when(F.col("event_id") % 2 == 0, a).otherwise(b).alias("json"))
    return Q.repeated_objects(e, ["run"], F.col("json"), "event_id", ["seq"]).select("run", "n", "first_page")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 0 THEN 'UNTRACED' WHEN o_orderkey % 10 = 0 THEN 'VALUE' WHEN length(o_orderpriority) > 10 THEN 'WIDTH' END AS fault FROM orders WHERE o_orderkey % 12 = 0 OR o_orderkey % 10 = 0 OR length(o_orderpriority) > 10""")
def view_parity(t):
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    view = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, F.lit("Z")).otherwise(F.col("o_orderstatus")))
    return Q.view_parity(view, o.filter("o_orderkey % 12 != 0"), "o_orderkey", ["o_orderstatus", "o_orderpriority"], {"o_orderpriority": 10})


@query("""SELECT 'quantity' AS rule, count(*) FILTER (NOT l_quantity BETWEEN 1 AND 49) AS broken FROM lineitem UNION ALL SELECT 'discount', count(*) FILTER (l_discount >= 0.1) FROM lineitem UNION ALL SELECT 'flag', count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') FROM lineitem""")
def invariants(t):
    return Q.invariants(t("lineitem"), {"quantity": F.col("l_quantity").between(1, 49), "discount": F.col("l_discount") < 0.1, "flag": ~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))})


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 0 THEN 0 ELSE length(text) END AS n FROM conversations WHERE (conv_id * 3 + turn) % 11 != 0), x AS (SELECT conv_id, turn, n, turn = max(turn) OVER (PARTITION BY conv_id) AS last FROM c)
SELECT conv_id, count(*) AS pages, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous, count(*) FILTER (n = 0 AND NOT last) > 0 AS early_empty FROM x GROUP BY 1""")
def page_completeness(t):
    c = t("conversations").filter("(conv_id * 3 + turn) % 11 != 0")
    c = c.select("conv_id", "turn", F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, 0).otherwise(F.length("text")).alias("n"))
    return Q.page_completeness(c, "conv_id", "turn", "n")


@query("""WITH p AS (SELECT conv_id, turn + 1 AS page, CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) AND conv_id % 5 != 4 OR conv_id % 9 = 0 AND turn = 0 THEN 0 ELSE 10 END AS rows, turn = max(turn) OVER (PARTITION BY conv_id) AND conv_id % 7 != 6 AS terminal FROM conversations WHERE (conv_id * 3 + turn) % 31 != 0 AND conv_id % 23 != 0),
s AS (SELECT conv_id, max(turn) + 1 + CASE WHEN conv_id % 19 = 1 THEN 1 ELSE 0 END AS pages, 10 * max(turn) + CASE WHEN conv_id % 5 = 4 THEN 10 ELSE 0 END - CASE WHEN conv_id % 9 = 0 AND max(turn) > 0 THEN 10 ELSE 0 END + CASE WHEN conv_id % 11 = 1 THEN 1 ELSE 0 END AS rows FROM conversations GROUP BY conv_id),
x AS (SELECT s.*, count(page) AS n, min(page) AS lo, max(page) AS hi, sum(p.rows) AS total, count(*) FILTER (terminal) AS terms, coalesce(bool_or(terminal) FILTER (last), false) AS t, max(p.rows) FILTER (last) AS r, count(*) FILTER (p.rows = 0 AND NOT last) AS early FROM s LEFT JOIN (SELECT *, page = max(page) OVER (PARTITION BY conv_id) AS last FROM p) p USING (conv_id) GROUP BY ALL)
SELECT conv_id, pages, rows, CASE WHEN n = 0 THEN 'NO_PAGES' WHEN lo != 1 OR hi != n THEN 'GAPS' WHEN n != pages THEN 'PAGES' WHEN total != rows THEN 'SUM' WHEN terms != 1 OR NOT t THEN 'TERMINAL' WHEN r != 0 THEN 'NOT_EMPTY' WHEN early > 0 THEN 'EARLY_EMPTY' END AS fault, n > 0 AND lo = 1 AND hi = n AND n = pages AND total = rows AND terms = 1 AND t AND r = 0 AND early = 0 AS complete FROM x""")
def page_evidence(t):
    c, last = t("conversations").select("conv_id", "turn"), F.max("turn").over(Window.partitionBy("conv_id"))
    own, k = t("conversations").filter("(conv_id * 3 + turn) % 31 != 0 and conv_id % 23 != 0").select("conv_id", "turn"), F.col("conv_id")
    end = F.col("turn") == last
    pages = own.select("conv_id", (F.col("turn") + 1).alias("page"), F.when((end & (k % 5 != 4)) | ((k % 9 == 0) & (F.col("turn") == 0)), 0).otherwise(10).alias("rows"), (end & (k % 7 != 6)).alias("terminal"))
    extra = lambda c, n: F.when(c, n).otherwise(0)
    stated = c.groupBy("conv_id").agg(F.max("turn").alias("m")).select("conv_id", (F.col("m") + 1 + extra(k % 19 == 1, 1)).cast("long").alias("pages"), (10 * F.col("m") + extra(k % 5 == 4, 10) - extra((k % 9 == 0) & (F.col("m") > 0), 10) + extra(k % 11 == 1, 1)).cast("long").alias("rows"))
    return Q.page_evidence(pages, stated, "conv_id", "page", "rows", "terminal")


@query("""WITH s AS (SELECT l_orderkey AS k, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem WHERE l_orderkey % 13 != 0 GROUP BY 1), v AS (SELECT l_orderkey AS k, count(*) + CASE WHEN l_orderkey % 10 = 1 THEN 1 ELSE 0 END AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, CASE WHEN l_orderkey % 9 = 2 THEN NULL WHEN sum(l_quantity) > 100 THEN 'BIG' ELSE 'SMALL' END AS st FROM lineitem WHERE l_orderkey % 15 != 0 GROUP BY l_orderkey)
SELECT coalesce(s.k, v.k) AS k, CASE WHEN s.k IS NULL OR v.k IS NULL THEN '*' ELSE 'n' END AS "column", CASE WHEN s.k IS NULL THEN 'UNTRACED' WHEN v.k IS NULL THEN 'MISSING' ELSE 'TOTAL' END AS fault, CASE WHEN s.k IS NOT NULL AND v.k IS NOT NULL THEN CAST(v.n AS VARCHAR) END AS published, CASE WHEN s.k IS NOT NULL AND v.k IS NOT NULL THEN CAST(s.n AS VARCHAR) END AS recomputed FROM s FULL JOIN v ON s.k = v.k WHERE s.k IS NULL OR v.k IS NULL OR s.n != v.n
UNION ALL SELECT s.k, 'st', 'STATE', v.st, CASE WHEN s.q > 100 THEN 'BIG' ELSE 'SMALL' END FROM s JOIN v ON s.k = v.k WHERE v.st IS DISTINCT FROM CASE WHEN s.q > 100 THEN 'BIG' ELSE 'SMALL' END""")
def recomputed(t):
    """A view of orders whose counts, and states by their quantity, are held against the lines."""
    l, k = t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("decimal(18,2)").alias("q")), F.col("k")  # noqa: E741
    totals, states = {"n": F.count(F.lit(1)), "q": F.sum("q")}, {"st": F.when(F.col("q") > 100, "BIG").otherwise("SMALL")}
    view = l.filter("k % 15 != 0").groupBy("k").agg(*[v.alias(c) for c, v in totals.items()]).withColumns(states)
    view = view.withColumns({"n": F.col("n") + F.when(k % 10 == 1, 1).otherwise(0), "st": F.when(k % 9 != 2, F.col("st"))})
    return Q.recomputed(view, l.filter("k % 13 != 0"), ["k"], totals, states)


@query("SELECT page_id % 5 AS run, sha256(html) AS h, count(*) AS n, min(page_id) AS first_page FROM (SELECT page_id, html FROM pages UNION ALL SELECT page_id + 1000000, html FROM pages WHERE page_id % 3 = 0) GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_pages(t):
    p = t("pages").select("page_id", "html")
    p = p.unionByName(p.filter("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1_000_000))
    return Q.repeated_pages(p.withColumn("run", F.col("page_id") % 5), ["run"], F.col("html"), "page_id")


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY 1)
SELECT day, list_filter([CASE WHEN n < 330 THEN 'FEW_ROWS' END, CASE WHEN e > 65 THEN 'ERRORS' END, CASE WHEN day(day) % 7 = 0 THEN 'HELD' END], lambda x: x IS NOT NULL) AS reasons, NOT (n < 330 OR e > 65 OR day(day) % 7 = 0) AS eligible FROM d""")
def sweep_eligibility(t):
    d = t("events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("e"))
    return Q.sweep_eligibility(d, [("FEW_ROWS", F.col("n") < 330), ("ERRORS", F.col("e") > 65), ("HELD", F.dayofmonth("day") % 7 == 0)]).select("day", "reasons", "eligible")


@query("""SELECT * FROM (SELECT DISTINCT event_type AS entity, unnest(json_keys(props)) AS field, 'ADDED' AS change FROM events WHERE event_type != 'view' UNION SELECT DISTINCT event_type, 'old', 'REMOVED' FROM events) WHERE entity != 'error' OR change != 'REMOVED'""")
def schema_drift(t):
    e = t("events")
    observed = e.select(F.col("event_type").alias("entity"), F.explode(F.json_object_keys("props")).alias("field"))
    kinds = e.select(F.col("event_type").alias("entity")).distinct()
    declared = kinds.select("entity", F.lit("old").alias("field")).unionByName(kinds.filter("entity = 'view'").select("entity", F.lit("k").alias("field")))
    allowed = kinds.filter("entity = 'error'").select("entity", F.lit("old").alias("field"), F.lit("REMOVED").alias("change"))
    return Q.schema_drift(declared, observed, allowed)


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderdate AS d, CASE WHEN o_orderkey % 25 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS m, o_orderstatus AS s FROM orders WHERE o_orderkey % 9 != 0),
b AS (SELECT o_orderkey AS k, o_orderdate AS d, CAST(o_totalprice + o_orderkey % 2 AS DECIMAL(18,2)) AS m, CASE WHEN o_orderkey % 10 = 0 THEN 'Z' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 8 != 0 UNION ALL SELECT o_orderkey, o_orderdate, 0, 'D' FROM orders WHERE o_orderkey % 77 = 0),
x AS (SELECT k, count(*) AS n, min(m) AS m, min(s) AS s FROM a WHERE d >= TIMESTAMP '1996-01-01' AND d < TIMESTAMP '2000-01-01' GROUP BY 1), y AS (SELECT k, count(*) AS n, min(m) AS m, min(s) AS s FROM b WHERE d >= TIMESTAMP '1996-01-01' AND d < TIMESTAMP '2000-01-01' GROUP BY 1),
j AS (SELECT x.n AS p, y.n AS q, x.m AS m, y.m AS o, x.s AS s, y.s AS u FROM x FULL JOIN y USING (k))
SELECT count(*) FILTER (p IS NULL) AS missing_left, count(*) FILTER (q IS NULL) AS missing_right, count(*) FILTER (p > 1 OR q > 1) AS duplicates, count(*) FILTER (p = 1 AND q = 1 AND m != o) AS money_differs, count(*) FILTER (p = 1 AND q = 1 AND s IS DISTINCT FROM u) AS status_differs, count(*) FILTER (p = 1 AND q = 1 AND (m IS NULL OR o IS NULL)) AS incomplete FROM j""")
def compare_keyed(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    a = o.filter("k % 9 != 0").select("k", "d", F.when(F.col("k") % 25 != 0, F.col("p").cast("decimal(18,2)")).alias("m"), "s")
    b = o.filter("k % 8 != 0").select("k", "d", (F.col("p") + F.col("k") % 2).cast("decimal(18,2)").alias("m"), F.when(F.col("k") % 10 == 0, "Z").otherwise(F.col("s")).alias("s"))
    b = b.unionByName(o.filter("k % 77 = 0").select("k", "d", F.lit(0).cast("decimal(18,2)").alias("m"), F.lit("D").alias("s")))
    return Q.compare_keyed(a, b, "k", "d", F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("2000-01-01").cast("timestamp_ntz"), "m", "s")


@query("""WITH a AS (SELECT conv_id AS page, conv_id * 1000 + turn AS key FROM conversations), b AS (SELECT conv_id + CASE WHEN conv_id % 17 = 0 AND turn = 0 THEN 1 ELSE 0 END AS page, conv_id * 1000 + turn + CASE WHEN conv_id % 9 = 0 THEN 500 ELSE 0 END AS key FROM conversations WHERE conv_id % 13 != 0),
s AS (SELECT page, key, sum(a) AS a, sum(b) AS b FROM (SELECT *, 1 AS a, 0 AS b FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY 1, 2), m AS (SELECT key FROM s GROUP BY key HAVING count(*) > 1)
SELECT page, CAST(sum(a) AS BIGINT) AS rows_a, CAST(sum(b) AS BIGINT) AS rows_b, count(*) FILTER (b = 0) AS only_a, count(*) FILTER (a = 0) AS only_b, count(*) FILTER (key IN (FROM m)) AS elsewhere, sum(a) = sum(b) AND count(*) FILTER (a = 0 OR b = 0 OR key IN (FROM m)) = 0 AS agree FROM s GROUP BY 1""")
def compare_traversals(t):
    """Pages that one traversal lacks, keys that changed, and keys that the second traversal found on the next page."""
    c, k = t("conversations"), F.col("conv_id")
    a = c.select(k.alias("page"), (k * 1000 + F.col("turn")).alias("key"))
    moved = F.when((k % 17 == 0) & (F.col("turn") == 0), 1).otherwise(0)
    b = c.filter("conv_id % 13 != 0").select((k + moved).alias("page"), (k * 1000 + F.col("turn") + F.when(k % 9 == 0, 500).otherwise(0)).alias("key"))
    return Q.compare_traversals(a, b, "page", "key")
