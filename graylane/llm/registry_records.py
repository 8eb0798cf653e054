"""Queries of periodic runs, the manifest and the quality rules, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graylane.llm import manifest, periodic_runs, quality_rules
from graylane.llm.common import crc_mod, table

_ID_CRC = "crc32(cast(cast(doc_id as string) as binary))"


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of docs; in a tenth of them, by the id's crc32, all words from one on repeat with a period."""
    rows = docs.select("doc_id", "text", F.expr(_ID_CRC).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)")).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    planted = F.expr("array_join(transform(sequence(0, n - 1), i -> w[if(i < a, i, a + (i - a) % p)]), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, a tenth of which get one by the id's crc32."""
    out = periodic_runs.find_runs(with_periods(table(spark, sf_dir, "documents")))
    out = out.withColumn("best", F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (m, r) -> if(m is null or r.length * m.period > m.length * r.period, r, m))"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents; a seventh of the leaves, by the id's crc32, is claimed with one character more."""
    claim = F.when(crc_mod("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = manifest.proofs(manifest.build(table(spark, sf_dir, "documents"), claims={"n_chars": claim}))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    proof = F.sha2(F.array_join(F.transform("proof", lambda s: F.lower(F.hex(s))), ""), 256)
    return out.select(F.col("key").alias("doc_id"), text("leaf"), text("subroot"), text("root"), proof.alias("proof_sha256"), text("folded_root"), "verified")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the quality rules, with their source as host."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


QUERIES = {"op11_periodic_runs": op11_periodic_runs, "op12_manifest": op12_manifest, "op13_quality_rules": op13_quality_rules}

_ALL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    step = "list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: {step}), 4294967295)"


def runs_sql(documents: str = "documents") -> str:
    """Rows of op11: stretches of words that equal those q places on, from pairs of equal windows of 16 words; of one stretch the least q."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h, coalesce({_ALL.format("text")}, []) AS o FROM {documents}),
n AS (SELECT *, len(o) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM n),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: o[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE o END AS w FROM p),
f AS (SELECT rid, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS f FROM (SELECT rid, w, unnest(range(n - 15)) AS i FROM w)),
r AS (SELECT x.rid, y.i - x.i AS q, x.i FROM f x JOIN f y ON x.rid = y.rid AND x.f = y.f AND x.i < y.i),
s AS (SELECT rid, q, min(i) AS s, max(i) + 16 + q - min(i) AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM r) GROUP BY rid, q, k),
t AS (SELECT rid, s, l, min(q) AS q FROM s WHERE l >= greatest(24, 3 * q) GROUP BY ALL),
u AS (SELECT * FROM t WHERE NOT EXISTS (FROM t z WHERE z.rid = t.rid AND z.q < t.q AND z.s <= t.s AND z.s + z.l >= t.s + t.l)),
v AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed, list(struct_pack(s := s, l := l, q := q) ORDER BY l * 1.0 / q DESC, s, q)[1] AS best FROM u GROUP BY rid),
x AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM u),
k AS (SELECT rid, list(i) AS gone FROM x GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, 1000 * best.l // best.q AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM w LEFT JOIN v USING (rid) LEFT JOIN k USING (rid)
"""


def manifest_sql(documents: str = "documents") -> str:
    """Rows of op12: levels from the leaves up, siblings by shifted places, the claimed leaf folded level by level."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda n: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", n, "text")) + ")"
    climb = lambda t, g: f"""{t} AS (
  SELECT {g}, 0 AS lvl, i, h, n FROM {t}0
  UNION ALL SELECT {g}, any_value(lvl) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM {t} WHERE n > 1 GROUP BY {g}, i // 2)"""  # noqa: E731
    fold = "CASE WHEN s.h IS NULL THEN sha256(f.h) WHEN (f.i >> f.lvl) & 1 = 1 THEN sha256(s.h || f.h) ELSE sha256(f.h || s.h) END"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {leaf("n_chars")} AS leaf, {leaf(f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS claimed FROM {documents}),
e AS (SELECT *, coalesce('+' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
t0 AS (SELECT g, i, leaf AS h, n FROM e),
{climb("t", "g")},
r AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u0 AS (SELECT 0 AS z, i, h, n FROM r),
{climb("u", "z")},
f AS (
  SELECT g, i AS own, claimed AS h, i, 0 AS lvl, n, '' AS proof FROM e
  UNION ALL SELECT f.g, f.own, {fold}, f.i, f.lvl + 1, (f.n + 1) // 2, f.proof || coalesce(s.h, '') FROM f LEFT JOIN t s ON s.g = f.g AND s.lvl = f.lvl AND s.i = xor(f.i >> f.lvl, 1) WHERE f.n > 1),
v AS (
  SELECT f.g, f.own, f.h, r.i, 0 AS lvl, r.n, f.proof, r.h AS subroot FROM f JOIN r USING (g) WHERE f.n = 1
  UNION ALL SELECT f.g, f.own, {fold}, f.i, f.lvl + 1, (f.n + 1) // 2, f.proof || coalesce(s.h, ''), f.subroot FROM v f LEFT JOIN u s ON s.lvl = f.lvl AND s.i = xor(f.i >> f.lvl, 1) WHERE f.n > 1)
SELECT e.doc_id, e.leaf, v.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(v.proof) AS proof_sha256, v.h AS folded_root, v.h = (SELECT h FROM u WHERE n = 1) AS verified
FROM e JOIN v ON v.g = e.g AND v.own = e.i WHERE v.n = 1
"""


def rules_sql(documents: str = "documents") -> str:
    """Rows of op13."""
    normal = "array_to_string(" + _ALL.format("translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')") + ", ' ')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, coalesce({_ALL.format("text")}, []) AS w FROM {documents}),
l AS (SELECT *, {normal} AS k, len({_ALL.format("t")}) AS n FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS t FROM d) WHERE regexp_matches(t, '[^\x20\x09-\x0D]')),
h AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
b AS (SELECT m.source, k FROM (SELECT source, k, count(DISTINCT text) AS c FROM l GROUP BY source, k) m JOIN h ON h.source IS NOT DISTINCT FROM m.source WHERE c > 5 AND 100 * c > 10 * docs),
c AS (SELECT rid, count(*) - count(DISTINCT t) AS dup, CAST(coalesce(sum(l.n) FILTER (b.k IS NOT NULL), 0) AS BIGINT) AS gone FROM l LEFT JOIN b ON b.k = l.k AND b.source IS NOT DISTINCT FROM l.source GROUP BY rid),
g AS (SELECT rid, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT rid, count(DISTINCT p) AS again FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1) GROUP BY rid),
o AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
             coalesce(again, 0) AS n_repeat_words, coalesce(gone, 0) AS n_removed_words FROM d LEFT JOIN c USING (rid) LEFT JOIN r USING (rid)),
x AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM o)
SELECT *, NOT base_failed AND 100 * (n_words - n_removed_words) >= 50 * n_words AS kept FROM x
"""


ORACLES = {"op11_periodic_runs": runs_sql(), "op12_manifest": manifest_sql(), "op13_quality_rules": rules_sql()}
