"""Queries that prove the column functions on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graylane.functions import scalar as S
from graylane.registry import query

_DAY = "CAST(o_orderdate AS DATE)"


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS bad FROM events")
def json_projection(t):
    """Envelopes with a declared schema; a text where a number is declared is null."""
    envelope = F.to_json(F.struct(F.lit("event").alias("entity"), F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), F.col("event_type").alias("bad")).alias("record")))
    r = S.typed_projection(envelope, "entity string, record struct<k: bigint, bad: bigint>")
    return t("events").select("event_id", r["record"]["k"].alias("k"), r["record"]["bad"].alias("bad"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' ELSE o_orderstatus END AS label FROM orders")
def label_map(t):
    return t("orders").select("o_orderkey", S.label(F.col("o_orderstatus"), {"O": "Open", "F": "Finished"}).alias("label"))


@query("""SELECT event_id, coalesce(c.label, raw) AS label, coalesce(c.terminal, false) AS terminal, c.code IS NOT NULL AS known
FROM (SELECT event_id, ' ' || upper(event_type) || '-Done ' AS raw FROM events) e
LEFT JOIN (VALUES ('signup_done', 'Signed up', true), ('view_done', 'Viewed', false), ('error_done', 'Failed', true)) c(code, label, terminal) ON c.code = replace(lower(trim(raw)), '-', '_')""")
def status_catalog(t):
    df = t("events").select("event_id", F.concat(F.lit(" "), F.upper("event_type"), F.lit("-Done ")).alias("raw"))
    catalog = df.sparkSession.createDataFrame([("signup_done", "Signed up", True), ("view_done", "Viewed", False), ("error_done", "Failed", True)], "code string, label string, terminal boolean")
    return S.status_catalog(df, "raw", catalog).select("event_id", "label", "terminal", "known")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount FROM orders""")
def parse_decimal(t):
    """Money texts with a sign and thousands' commas; every fifth blank, every fifth broken."""
    text = F.concat(F.lit("R$ "), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2))
    text = F.when(F.col("o_orderkey") % 5 == 0, "  ").when(F.col("o_orderkey") % 5 == 1, F.concat(text, F.lit("x1"))).otherwise(text)
    return t("orders").select("o_orderkey", S.parse_decimal(text, 18, 2).alias("amount"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN json_extract_string(props, '$.k') || 'e3' WHEN 2 THEN json_extract_string(props, '$.k') WHEN 3 THEN json_extract_string(props, '$.k') || chr(10) WHEN 4 THEN '-' || json_extract_string(props, '$.k') || '.25' END AS x FROM events)
SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'ABSENT' WHEN event_id % 6 = 5 THEN 'NULL' WHEN regexp_full_match(x, '-?[0-9]{1,29}([.][0-9]{1,9})?') THEN 'VALID' ELSE 'INVALID' END AS state,
CASE WHEN regexp_full_match(x, '-?[0-9]{1,29}([.][0-9]{1,9})?') THEN CAST(x AS DECIMAL(38,9)) END AS number FROM e""")
def strict_number(t):
    """Absent, null, with an exponent, with a line end behind it, and right ones."""
    k, i = F.get_json_object("props", "$.k"), F.col("event_id") % 6
    text = F.when(i == 1, F.concat(k, F.lit("e3"))).when(i == 2, k).when(i == 3, F.concat(k, F.lit("\n"))).when(i == 4, F.concat(F.lit("-"), k, F.lit(".25")))
    json = F.when(i == 0, "{}").when(i == 5, '{"x": null}').otherwise(F.to_json(F.struct(text.alias("x"))))
    n = S.strict_number(F.get_json_object(json, "$.x"), S.presence(json, "x"))
    return t("events").select("event_id", n["state"].alias("state"), n["number"].alias("number"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'VALUE' WHEN 1 THEN 'NULL' ELSE 'ABSENT' END AS k_state FROM events""")
def presence(t):
    json = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.lit('{"k": null}')).otherwise(F.lit('{"j": 1}'))
    return t("events").select("event_id", S.presence(json, "k").alias("k_state"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'doc:' || lpad(CAST(c_custkey AS VARCHAR), 14, '0') ELSE 'name:' || upper(c_name) END AS party FROM customer""")
def party_key(t):
    doc = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("#"), F.lpad(F.col("c_custkey").cast("string"), 14, "0"), F.lit("-"))).otherwise(F.col("c_custkey").cast("string"))
    return t("customer").select("c_custkey", S.party_key(doc, F.concat(F.lit(" "), F.lower("c_name"))).alias("party"))


@query("""WITH d AS (SELECT doc_id, strip_accents(lower(coalesce(text, ''))) AS x FROM documents)
SELECT doc_id, position('que' IN x) > 0 AND position('os' IN substr(x, position('que' IN x) + 3)) > 0 AS both_found, starts_with(x, 'e') AS starts FROM d""")
def ci_ai_match(t):
    """Tokens with accents, and texts in which a, e and o have theirs as characters of their own."""
    text = F.coalesce("text", F.lit(""))
    for plain, apart in (("\u00e9", "e\u0301"), ("\u00f3", "o\u0301"), ("\u00fc", "u\u0308")):
        text = F.replace(text, F.lit(plain), F.lit(apart))
    return t("documents").select("doc_id", S.contains_tokens(text, ["QU\u00ca", "\u01d2s"]).alias("both_found"), S.starts_with_ci_ai(text, "\u00c9").alias("starts"))


@query("SELECT event_id, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Sao_Paulo' AS DATE) AS day FROM events")
def civil_date(t):
    return t("events").select("event_id", S.civil_date(F.col("ts"), "America/Sao_Paulo").alias("day"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%H:%M:%S') WHEN event_id % 3 = 1 THEN strftime(ts, '%H:%M') END AS clock FROM events")
def clock_text(t):
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "HH:mm")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return t("events").select("event_id", S.clock_text(text).alias("clock"))


@query("SELECT p_partkey, p_type AS token FROM part")
def type_token(t):
    return t("part").select("p_partkey", S.type_token(F.concat(F.lit("Part::Kind::"), "p_type")).alias("token"))


@query(r"SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR) || '|' || coalesce(nullif(o_orderstatus, 'P'), '\N') || '|' || o_orderpriority) AS h FROM orders")
def row_hash(t):
    df = t("orders").withColumn("s", F.nullif("o_orderstatus", F.lit("P")))
    return df.select("o_orderkey", S.row_hash(["o_orderkey", "s", "o_orderpriority"]).alias("h"))


@query("SELECT p_partkey, sha256(strlen(p_name) || ':' || p_name || coalesce(strlen(b) || ':' || b, '-1:')) AS h FROM (SELECT *, nullif(p_brand, 'Brand#2') AS b FROM part)")
def framed_hash(t):
    return t("part").withColumn("b", F.nullif("p_brand", F.lit("Brand#2"))).select("p_partkey", S.framed_hash(["p_name", "b"]).alias("h"))


@query("""WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, event_id % 4 AS i FROM events), v AS (SELECT *, CASE WHEN i = 3 THEN '"1|k=' || k || '"' ELSE k END AS kv, '{"x":[1,{"p":2,"q":"' || k || '"}],"y":null}' AS o FROM e)
SELECT event_id, CASE WHEN i != 2 OR event_id % 8 != 2 THEN sha256('1:a1:1' || '1:k' || strlen(kv) || ':' || kv || '1:o' || strlen(o) || ':' || o) END AS h FROM v""")
def stable_json_hash(t):
    """Neither the order of fields matters, of inner objects too, nor the volatile field `seen`; a text that looks like two fields is one; what is no JSON has no hash."""
    k, i = F.get_json_object("props", "$.k"), F.col("event_id") % 4
    value = F.when(i == 3, F.concat(F.lit('"1|k='), k, F.lit('"'))).otherwise(k)
    a = F.concat(F.lit('{"k": '), value, F.lit(', "seen": "x", "a": 1, "o": {"y": null, "x": [1, {"q": "'), k, F.lit('", "p": 2}]}}'))
    b = F.concat(F.lit('{"o": {"x": [1, {"p": 2, "q": "'), k, F.lit('"}], "y": null}, "a": 1, "seen": {"z": 1}, "k": '), value, F.lit("}"))
    json = F.when(F.col("event_id") % 8 == 2, F.concat(F.lit("{"), a)).when(F.col("event_id") % 2 == 0, a).otherwise(b)
    return t("events").select("event_id", S.stable_json_hash(json, ["seen"]).alias("h"))


@query("SELECT event_id, sha256(CASE WHEN event_id % 3 = 0 THEN 'id:' || event_id WHEN event_id % 3 = 1 THEN 'user:' || user_id ELSE 'type:' || event_type END) AS h FROM events")
def identity_key(t):
    k = F.col("event_id") % 3
    return t("events").select("event_id", S.identity_key([("id", F.when(k == 0, F.col("event_id"))), ("user", F.when(k == 1, F.col("user_id"))), ("type", F.col("event_type"))]).alias("h"))


@query("""SELECT doc_id, array_to_string(list_sort(list_filter(list_transform(string_split(text, ' '), lambda x: trim(x, ' ')), lambda x: x != '')), ',') AS words FROM documents""")
def canonical_list(t):
    return t("documents").select("doc_id", S.canonical_list(F.split("text", " ")).alias("words"))


@query("SELECT p_partkey, contains(strip_accents(lower(p_name)), 'part') AS has, starts_with(lower(p_type), 'st') AS starts FROM part")
def ci_ai_parts(t):
    """A token and a prefix whatever case and accents they are given in."""
    return t("part").select("p_partkey", S.contains_ci_ai(F.col("p_name"), "P\u00e1RT").alias("has"), S.starts_with_ci_ai(F.col("p_type"), "\u015aT").alias("starts"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts ELSE ts + INTERVAL 3 HOUR END AS at FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def to_instant(t):
    """Even rows give an offset, the others the local time of a zone three hours behind."""
    text = F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss")
    given = F.when(F.col("event_id") % 2 == 0, F.concat(text, F.lit("Z"))).otherwise(text)
    return t("events").select("event_id", S.to_instant(given, "Etc/GMT+3").cast("timestamp_ntz").alias("at"))


@query("""SELECT conv_id, regexp_replace(string_agg(role, ', ' ORDER BY turn, role), '[\\[\\]"]', '', 'g') AS roles FROM conversations GROUP BY conv_id""")
def join_array(t):
    by = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    return by.select("conv_id", S.join_array(F.col("r.role")).alias("roles"))


@query("""SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS amount FROM events UNION ALL SELECT event_id, 'v', CAST(value AS DECIMAL(18,2)) FROM events""")
def explode_amounts(t):
    json = F.format_string('{"k": %s, "v": %s}', F.get_json_object("props", "$.k"), F.col("value").cast("decimal(18,2)").cast("string"))
    return t("events").select("event_id", F.explode(S.amounts(json)).alias("name", "amount"))


@query("""SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) + coalesce(CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS DECIMAL(18,2)), 0)) AS total FROM lineitem GROUP BY 1""")
def sum_components(t):
    parts = S.sum_components([F.col("l_extendedprice"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity"))])
    return t("lineitem").groupBy("l_orderkey").agg(F.sum(parts).alias("total"))


@query("""SELECT band, count(*) AS n, count(*) FILTER (days <= 0) AS on_time FROM (SELECT days, CASE WHEN days <= -4 THEN '-4 or less' WHEN days >= 4 THEN '+4 or more' WHEN days > 0 THEN '+' || days ELSE CAST(days AS VARCHAR) END AS band
FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - 60 AS days FROM orders JOIN lineitem ON o_orderkey = l_orderkey)) GROUP BY band""")
def delay_band(t):
    days = F.datediff("l_shipdate", "o_orderdate") - 60
    j = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(days.alias("days"))
    return j.groupBy(S.delay_band(F.col("days")).alias("band")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("days") <= 0).alias("on_time"))


@query("""WITH x AS (SELECT event_id, event_type, 'A' || user_id % 7 AS o, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'B' || user_id % 5 END AS d, CAST(CASE WHEN event_id % 5 != 0 THEN event_id * 37 % 60000 - 100 END AS BIGINT) AS m, event_id * 41 % 50000 - 10 AS p, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS ts FROM events),
y AS (SELECT *, CASE WHEN ts IS NOT NULL THEN epoch(date_trunc('minute', ts + p * INTERVAL 1 MINUTE)) // 60 - epoch(date_trunc('minute', ts)) // 60 END AS q FROM x), z AS (SELECT *, CASE WHEN m BETWEEN 0 AND 43200 THEN m WHEN q BETWEEN 0 AND 43200 THEN CAST(q AS BIGINT) END AS n FROM y)
SELECT event_id, CASE WHEN d IS NOT NULL THEN o END AS origin, coalesce(d, event_type) AS destination, CASE WHEN d IS NULL THEN 'type' ELSE 'route' END AS provenance,
lpad(CAST(n // 60 AS VARCHAR), CAST(greatest(2, length(CAST(n // 60 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') AS duration,
CASE WHEN m BETWEEN 0 AND 43200 THEN 'DIRECT' WHEN q BETWEEN 0 AND 43200 THEN 'PREDICTED_DIFFERENCE' ELSE 'INVALID_OR_ABSENT' END AS duration_from, m IS NOT NULL AND m NOT BETWEEN 0 AND 43200 AS invalid FROM z""")
def transit_time(t):
    """Route texts with a missing half fall back to another column; durations out of bounds or missing to the planned times."""
    route = F.concat(F.lit("A"), (F.col("user_id") % 7).cast("string"), F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.lit(" X B"), (F.col("user_id") % 5).cast("string"))))
    origin, destination = S.route_parts(route)
    e = t("events").withColumn("start", F.when(F.col("event_id") % 3 != 0, F.col("ts").cast("timestamp")))
    stated = F.when(F.col("event_id") % 5 != 0, F.col("event_id") * 37 % 60000 - 100).cast("long")
    planned = F.expr("start + make_dt_interval(0, 0, cast(event_id * 41 % 50000 - 10 as int))")
    minutes, duration_from, invalid = S.transit_minutes(stated, F.col("start"), F.lit(None).cast("timestamp"), planned)
    return e.select("event_id", origin.alias("origin"), F.coalesce(destination, "event_type").alias("destination"), F.when(destination.isNull(), "type").otherwise("route").alias("provenance"), S.duration_text(minutes).alias("duration"), duration_from.alias("duration_from"), invalid.alias("invalid"))


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 10 END AS paid FROM orders)
SELECT o_orderkey, CASE WHEN paid <= DATE '1998-06-30' THEN 'PAID' WHEN d + 30 < DATE '1998-06-30' THEN 'OVERDUE' ELSE 'OPEN' END AS state, greatest(0, date_diff('day', d + 30, DATE '1998-06-30')) AS days_due FROM o""")
def payment_state(t):
    day, at = F.to_date("o_orderdate"), F.lit("1998-06-30").cast("date")
    due, paid = F.date_add(day, 30), F.when(F.col("o_orderstatus") == "F", F.date_add(day, 10))
    return t("orders").select("o_orderkey", S.payment_state(paid, due, at).alias("state"), F.greatest(F.lit(0), F.datediff(at, due)).cast("long").alias("days_due"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'type' WHEN value < 1 THEN 'value' WHEN user_id % 10 = 0 THEN 'user' END AS evidence FROM events")
def first_evidence(t):
    return t("events").select("event_id", S.first_evidence([("type", F.col("event_type") == "error"), ("value", F.col("value") < 1), ("user", F.col("user_id") % 10 == 0)]).alias("evidence"))


@query("""SELECT o_orderkey, greatest(o_orderdate, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - 1 AS INTEGER) + 1 AS TIMESTAMP)) AS fresh FROM orders""")
def freshness_max(t):
    day = F.expr("date_add(to_date(o_orderdate), cast(o_orderkey % 3 - 1 as int))")
    return t("orders").select("o_orderkey", S.freshness_max([F.col("o_orderdate")], [day]).cast("timestamp_ntz").alias("fresh"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate WHEN o_orderkey % 3 = 1 THEN CAST(CAST(o_orderdate AS DATE) + 3 AS TIMESTAMP) WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 HOUR END AS fresh FROM orders""")
def freshness_first(t):
    """An instant, else the end of a civil day two days on, else another instant, else nothing."""
    i = F.col("o_orderkey") % 3
    sources = [("instant", F.when(i == 0, F.col("o_orderdate"))), ("day", F.when(i == 1, F.date_add(F.to_date("o_orderdate"), 2))), ("instant", F.when(F.col("o_orderkey") % 2 == 0, F.expr("o_orderdate + make_dt_interval(0, 1)")))]
    return t("orders").select("o_orderkey", S.freshness_first(sources).cast("timestamp_ntz").alias("fresh"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 3 THEN NULL ELSE date_trunc('second', ts) END AS at, CASE event_id % 4 WHEN 0 THEN 'updated' WHEN 1 THEN 'updated' WHEN 2 THEN 'created' END AS origin,
CASE event_id % 4 WHEN 0 THEN 'INVALID' WHEN 3 THEN 'MISSING' ELSE 'OK' END AS reason FROM events""")
def freshness_strict(t):
    """A broken first source blocks; it doesn't fall through to the second."""
    k, text = F.col("event_id") % 4, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    f = S.freshness_strict([("updated", F.when(k == 0, "not a time").when(k == 1, text)), ("created", F.when(k.isin(0, 1, 2), text))])
    return t("events").select("event_id", f["at"].cast("timestamp_ntz").alias("at"), f["origin"].alias("origin"), f["reason"].alias("reason"))


@query("SELECT event_id, 'event:' || v AS key, v = trim(v) AND NOT contains(v, chr(10)) AS valid FROM (SELECT event_id, event_id || CASE event_id % 3 WHEN 0 THEN ' ' WHEN 1 THEN chr(10) ELSE '' END AS v FROM events)")
def typed_key(t):
    """A blank or a line end behind the value makes it invalid."""
    end = F.when(F.col("event_id") % 3 == 0, " ").when(F.col("event_id") % 3 == 1, "\n").otherwise("")
    k = S.typed_key("event", F.concat(F.col("event_id").cast("string"), end))
    return t("events").select("event_id", k["key"].alias("key"), k["valid"].alias("valid"))


@query("SELECT year(o_orderdate) * 100 + month(o_orderdate) AS month, count(*) AS n, count(*) FILTER (day(o_orderdate) = 1) AS first_days FROM orders GROUP BY 1")
def yyyymm(t):
    return t("orders").groupBy(S.yyyymm(F.col("o_orderdate")).cast("long").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.dayofmonth("o_orderdate") == 1).alias("first_days"))
