"""Queries that prove landing, publication and streaming on the supplied tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from graylane import storage
from graylane.registry import query
from graylane.sources import landing as L
from graylane.sources import marked, versions
from graylane.streaming import jobs


@query("""WITH o AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day, event_id % 4 AS run, ts FROM events), r AS (SELECT event_type, day, run, max(ts) AS stored FROM o GROUP BY 1, 2, 3),
l AS (SELECT event_type, day, run FROM r WHERE run != 3 QUALIFY row_number() OVER (PARTITION BY event_type, day ORDER BY stored DESC, run DESC) = 1) SELECT event_id FROM o JOIN l USING (event_type, day, run)""")
def latest_capture(t):
    o = t("events").select("event_id", "event_type", F.to_date("ts").alias("day"), (F.col("event_id") % 4).alias("run"), "ts")
    runs = o.groupBy("event_type", "day", "run").agg(F.max("ts").alias("stored"))
    return L.latest_capture(o, runs, ["event_type", "day"], "run", "stored", F.col("run") != 3).select("event_id")


@query("SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, CASE WHEN event_type IN ('view', 'click') THEN CAST(ts AS DATE) END ORDER BY ts DESC, event_id DESC) = 1")
def latest_snapshot(t):
    e = t("events").withColumn("day", F.to_date("ts"))
    return L.latest_snapshot(e, "event_type", "day", F.col("event_type").isin("view", "click"), [F.desc("ts"), F.desc("event_id")]).select("event_id")


@query("SELECT DISTINCT md5(text) AS h FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 3 = 0)")
def append_once(t):
    d = t("documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    return L.append_once(d.filter("doc_id % 3 = 0"), d.filter("doc_id % 3 != 0"), ["h"]).select("h")


@query("""SELECT 'FIELDS' AS code, count(*) FILTER (event_id % 50 = 1) AS n FROM events UNION ALL SELECT 'DAY', count(*) FILTER (event_id % 40 = 3) FROM events UNION ALL SELECT 'DUPLICATE_KEY', count(*) FILTER (event_id % 100 = 7) FROM events UNION ALL SELECT 'COUNT', count(*) FILTER (event_id % 100 = 7) FROM events""")
def check_capture(t):
    e = t("events")
    day = F.when(F.col("event_id") % 40 == 3, F.date_add(F.to_date("ts"), 1)).otherwise(F.to_date("ts"))
    record = F.struct(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("event_id") % 50 == 1, F.lit(1)).alias("extra"))
    rows = e.select("event_id", day.alias("business_date"), F.to_json(F.struct(F.lit("event").alias("entity"), record.alias("record"))).alias("envelope"))
    rows = rows.unionByName(rows.filter("event_id % 100 = 7"))
    return L.check_capture(rows, "envelope", ["id", "day"], "id", "day", e.count())


@query("SELECT 'DAY' AS code, count(*) AS n FROM events WHERE event_id % 40 = 3")
def check_capture_local(t):
    """Instants belong to the day that they have in the zone, three hours behind UTC; a capture without faults is landed whole, and once though it comes twice."""
    e = t("events")
    local = F.to_date(F.col("ts") - F.expr("INTERVAL 3 HOURS"))
    record = F.struct(F.col("event_id").alias("id"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("at"))
    rows = e.select("event_id", local.alias("business_date"), F.to_json(F.struct(F.lit("event").alias("entity"), record.alias("record"))).alias("envelope"))
    path = storage.new_path(e.sparkSession, "landed")
    for _ in range(2):
        L.land_capture(rows, L.check_capture(rows, "envelope", ["id", "at"], "id", "at", e.count(), "Etc/GMT+3"), path, "first")
    moved = e.sparkSession.read.parquet(path).withColumn("business_date", F.date_add("business_date", F.when(F.col("event_id") % 40 == 3, 1).otherwise(0)))
    return L.check_capture(moved, "envelope", ["id", "at"], "id", "at", e.count(), "Etc/GMT+3")


@query("SELECT o_orderstatus, count(*) AS n, 2 AS version, 2 AS folders, 'moved, late' AS refused FROM orders WHERE o_orderkey % 3 != 0 GROUP BY 1")
def publish_fenced(t):
    """Two publications that hold, between them one whose coverage moves and after them one that started before the last: neither leaves anything."""
    o = t("orders")
    spark, base, turn = o.sparkSession, storage.new_path(o.sparkSession, "published"), iter(range(9))
    by_status = lambda df: {"by_status": df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), "keys": df.select("o_orderkey")}
    fence = lambda: o.agg(F.max("o_orderkey").alias("last"))
    versions.publish(spark, base, by_status(o), fence)
    refused = []
    try:
        versions.publish(spark, base, by_status(o.limit(0)), lambda: fence().withColumn("last", F.col("last") + next(turn)))
    except versions.Lost:
        refused.append("moved")

    def overtaken():
        if next(turn) == 2:
            versions.publish(spark, base, by_status(o.filter("o_orderkey % 3 != 0")), fence)
        return fence()

    try:
        versions.publish(spark, base, by_status(o.limit(0)), overtaken)
    except versions.Lost:
        refused.append("late")
    facts = {"version": versions.current(spark, base)[0], "folders": len(versions.listed(spark, f"{base}/versions")), "refused": ", ".join(refused)}
    return versions.read(spark, base, "by_status").withColumns({k: F.lit(v) for k, v in facts.items()})


@query("SELECT o_orderkey, 'live' AS origin FROM orders WHERE o_orderkey % 2 = 0")
def prepared_or_live(t):
    o = t("orders")
    return L.prepared_or_live(o.select("o_orderkey", F.lit("prepared").alias("origin")), o.filter("o_orderkey % 2 = 0").select("o_orderkey", F.lit("live").alias("origin")), o.filter("o_orderkey = 1"))


@query("SELECT o_orderstatus, count(*) AS n, true AS built, false AS rebuilt, true AS rebuilt_after_change FROM orders GROUP BY 1")
def signature_gate(t):
    """Two runs over the same inputs: the second keeps what the first built; a third over changed inputs builds anew."""
    o = t("orders")
    first, sign, built = L.rebuild_if_changed(o, None, lambda: o, lambda: o)
    again, _, rebuilt = L.rebuild_if_changed(o.repartition(3), sign, lambda: o.limit(0), lambda: first)
    changed = L.rebuild_if_changed(o.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") == 1, 1).otherwise(0)), sign, lambda: o, lambda: first)[2]
    return again.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumns({"built": F.lit(built), "rebuilt": F.lit(rebuilt), "rebuilt_after_change": F.lit(changed)})


# every eleventh date of the source is a year later than the target's: rows move into the window, within it and out of it
_SYNC = """a AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders WHERE o_orderkey % 7 != 0),
b AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 11 = 0 THEN 365 ELSE 0 END AS d, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS v FROM orders WHERE o_orderkey % 9 != 0),
x AS (SELECT * FROM b WHERE d BETWEEN DATE '1996-01-01' AND DATE '1998-12-31')"""


def _sync_sides(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    source = o.filter("k % 9 != 0").withColumn("v", (F.col("v") + F.when(F.col("k") % 4 == 0, 1).otherwise(0)).cast("decimal(18,2)")).withColumn("d", F.date_add("d", F.when(F.col("k") % 11 == 0, 365).otherwise(0)))
    return o.filter("k % 7 != 0"), source, F.lit("1996-01-01").cast("date"), F.lit("1998-12-31").cast("date")


@query(f"""WITH {_SYNC} SELECT coalesce(a.k, x.k) AS k, CASE WHEN a.k IS NULL THEN 'INSERT' WHEN x.k IS NOT NULL AND a.d = x.d AND a.v = x.v THEN 'KEEP' WHEN x.k IS NOT NULL THEN 'UPDATE' WHEN a.d BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' THEN 'DELETE' ELSE 'OUTSIDE' END AS action FROM a FULL JOIN x ON a.k = x.k""")
def sync_window(t):
    target, source, lo, hi = _sync_sides(t)
    return L.sync_window(target, source, "k", "d", lo, hi)


@query(f"""WITH {_SYNC} SELECT k, d, v, year(d) AS y FROM x UNION ALL SELECT k, d, v, year(d) FROM a WHERE d NOT BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND k NOT IN (SELECT k FROM x)""")
def sync_window_applied(t):
    """Written by partitions of a year and read back: each key once, the window as the source has it after its rows and amounts add up to what it states."""
    target, source, lo, hi = _sync_sides(t)
    spark, base = target.sparkSession, storage.new_path(target.sparkSession, "synced")
    first = target.withColumn("y", F.year("d"))
    marked.create(spark, base, first.schema, ["y"])
    marked.replace(spark, base, first, first.select("y").distinct())
    fresh = source.filter(F.col("d").between(lo, hi))
    L.sync_keyed(base, fresh, "k", "d", F.year("d"), lo, hi, "v", *fresh.agg(F.count(F.lit(1)), F.sum("v")).first())
    return marked.read(spark, base)


@query("SELECT CAST(d AS DATE) AS day FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY) r(d) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 300000)")
def missing_days(t):
    return L.missing_days(t("orders").filter("o_totalprice > 300000").select(F.to_date("o_orderdate").alias("day")), "day", "1995-01-01", "2001-12-31")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'")
def read_contract(t):
    contract = StructType([StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType())])
    return L.read_contract(t("orders"), contract, F.col("o_orderpriority") == "1-URGENT", [F.asc("o_orderkey")], 2_000_000_000)


@query("SELECT CAST(p_size AS BIGINT) % 5 AS release, p_partkey AS k FROM part WHERE p_size % 5 >= 2")
def import_release(t):
    """Releases 0 and 1 are stored and come again unchanged; the others are appended."""
    n = t("part").select((F.col("p_size").cast("long") % 5).alias("release"), F.col("p_partkey").alias("k"))
    return L.import_release(n.filter("release < 2"), n, "release")


@query("SELECT event_id, event_type, CASE WHEN value >= 1 THEN 'bronze' ELSE 'quarantine' END AS landed FROM events")
def stream_landing(t):
    spark = t("events").sparkSession
    base = storage.new_path(spark, "stream-landing")
    t("events").select("event_id", "event_type", "value").write.json(f"{base}/in")
    jobs.stream_captures(spark, f"{base}/in", "event_id bigint, event_type string, value double", F.col("value") >= 1, f"{base}/out", f"{base}/checkpoint")
    rows = [spark.read.schema("event_id bigint, event_type string, value double").parquet(f"{base}/out/{k}/batch=*").select("event_id", "event_type", F.lit(k).alias("landed")) for k in ("bronze", "quarantine")]
    return rows[0].unionByName(rows[1])


@query("""WITH e AS (SELECT event_id, user_id % 40 AS u, count(*) OVER (PARTITION BY user_id % 40) AS n FROM events), r AS (SELECT u, any_value(n) AS n FROM e GROUP BY u)
SELECT 'run' || u AS run, CASE WHEN u % 5 = 0 THEN 'REJECTED' WHEN u % 7 = 0 THEN 'OPEN' ELSE 'ACCEPTED' END AS decision, CASE WHEN u % 5 = 0 OR u % 7 = 0 THEN 0 ELSE n END AS landed, CASE WHEN u % 5 = 0 THEN 'DUPLICATE_KEY' END AS codes FROM r""")
def stream_captures_whole(t):
    """Three batches: captures whose rows come in two of them, every fifth with a key twice, every seventh with a row less than it states, and all that were accepted a second time in the third."""
    spark = t("events").sparkSession
    base = storage.new_path(spark, "stream-captures")
    e = t("events").select("event_id", (F.col("user_id") % 40).alias("u"))
    n = F.count(F.lit(1)).over(Window.partitionBy("u"))
    k = F.row_number().over(Window.partitionBy("u").orderBy("event_id"))
    e = e.withColumns({"k": k, "n": n})
    key = F.when((F.col("u") % 5 == 0) & (F.col("k") == 1), -F.col("u")).when((F.col("u") % 5 == 0) & (F.col("k") == 2), -F.col("u")).otherwise(F.col("event_id"))
    record = F.struct(key.alias("id"), F.lit("2024-05-01").alias("day"))
    expected = F.col("n") + F.when((F.col("u") % 7 == 0) & (F.col("u") % 5 != 0), 1).otherwise(0)
    rows = e.select(F.concat(F.lit("run"), "u").alias("run"), F.lit("2024-05-01").cast("date").alias("business_date"), expected.alias("expected"), F.col("k").cast("long").alias("ordinal"), F.to_json(F.struct(record.alias("record"))).alias("envelope"), (F.col("k") % 2).alias("half"))
    for part in (rows.filter("half = 0"), rows.filter("half = 1"), rows):
        part.drop("half").coalesce(1).write.mode("append").json(f"{base}/in")
        jobs.stream_landing(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", ["id", "day"], "id", "day")
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{base}/out/{name}")
    decisions = read("decisions", "run string, decision string, batch long").filter("decision != 'REPLAY'").select("run", "decision")
    landed = read("bronze", jobs.CAPTURE).groupBy("run").agg(F.count(F.lit(1)).alias("landed"))
    codes = read("violations", "run string, code string, n long").filter("code != 'COUNT'").groupBy("run").agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes"))
    out = rows.select("run").distinct().join(decisions, "run", "left").join(landed, "run", "left").join(codes, "run", "left")
    return out.select("run", F.coalesce("decision", F.lit("OPEN")).alias("decision"), F.coalesce("landed", F.lit(0)).alias("landed"), "codes")


def _stream_sql():
    """Three batches one after the other: each key's freshest rows of a batch, if of one type, against the state before."""
    def won(k, rows):
        return f"""w{k} AS (SELECT user_id, max(f) AS f, min(event_type) AS e FROM (SELECT *, max(f) OVER (PARTITION BY user_id) AS m FROM {rows}) WHERE f = m GROUP BY user_id HAVING min(event_type) = max(event_type))"""

    def state(k):
        return f"""s{k} AS (SELECT coalesce(s.user_id, w.user_id) AS user_id, CASE WHEN s.f IS NULL OR w.f > s.f THEN w.f ELSE s.f END AS f, CASE WHEN s.f IS NULL OR w.f > s.f THEN w.e ELSE s.e END AS e,
coalesce(s.conflicts, 0) + CASE WHEN w.f = s.f AND w.e != s.e THEN 1 ELSE 0 END AS conflicts, coalesce(s.replays, 0) + CASE WHEN w.f = s.f AND w.e = s.e THEN 1 ELSE 0 END AS replays FROM s{k - 1} s FULL JOIN w{k} w ON s.user_id = w.user_id)"""

    return f"""WITH v AS (SELECT event_id, user_id, date_trunc('day', ts) AS f, event_type FROM events), a AS (SELECT * FROM v WHERE event_id % 3 = 0), b AS (SELECT * FROM v WHERE event_id % 3 = 1), c AS (SELECT * FROM v WHERE event_id % 3 = 2 AND event_id % 5 != 0 UNION ALL SELECT * FROM a WHERE event_id % 2 = 0),
{won(1, "a")}, {won(2, "b")}, {won(3, "c")}, s1 AS (SELECT *, 0 AS conflicts, 0 AS replays FROM w1), {state(2)}, {state(3)} SELECT user_id, f, e AS event_type, CAST(conflicts AS BIGINT) AS conflicts, CAST(replays AS BIGINT) AS replays FROM s3"""


@query(_stream_sql())
def stream_apply(t):
    """Three micro-batches, the third with rows of the first again, then a restart without new rows: the state, and how often a key met a conflict or a replay."""
    spark = t("events").sparkSession
    base = storage.new_path(spark, "stream-apply")
    e = t("events").select("event_id", "user_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("f"), "event_type")
    third = e.filter("event_id % 3 = 2 and event_id % 5 != 0").unionByName(e.filter("event_id % 6 = 0"))
    for part in (e.filter("event_id % 3 = 0"), e.filter("event_id % 3 = 1"), third):
        part.repartition(4, "event_id").write.mode("append").parquet(f"{base}/in")
    for _ in range(2):
        stream = spark.readStream.schema("event_id bigint, user_id bigint, f timestamp, event_type string").option("maxFilesPerTrigger", 4).parquet(f"{base}/in")
        jobs.stream_apply(stream, "user_id", "f", "event_type", "event_id", f"{base}/out", f"{base}/checkpoint")
    met = spark.read.parquet(f"{base}/out/decisions").groupBy("user_id").agg(F.count_if(F.col("decision") == "CONFLICT").alias("conflicts"), F.count_if(F.col("decision") == "REPLAY").alias("replays"))
    state = jobs.current_state(spark, f"{base}/out", "user_id", "f", "event_type").join(met, "user_id")
    return state.select("user_id", F.col("f").cast("timestamp_ntz").alias("f"), "event_type", "conflicts", "replays")


@query("SELECT event_id, event_type FROM events")
def stream_dedupe(t):
    """All events come twice; one of each stays."""
    spark = t("events").sparkSession
    base = storage.new_path(spark, "stream-dedupe")
    e = t("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.unionByName(e).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("event_id bigint, event_type string, ts timestamp").parquet(f"{base}/in")
    jobs.stream_dedupe(stream, ["event_id"], "ts", "120 seconds", f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema("event_id bigint, event_type string, ts timestamp").parquet(f"{base}/out").select("event_id", "event_type")
