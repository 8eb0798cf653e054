"""Benchmark decontamination by a distributed positional index (DataFrame operations only).

1. Count, over all training texts, the occurrences of every word of the benchmark.
2. A phrase is a window of 13 consecutive words of an item (all its words if it has fewer). Its RARE rarest words, with
   their places in it, are what is looked up. A phrase with a word that no text has cannot occur.
3. Store the postings (text, word, position) of these words, in one pass over the texts that moves none of them.
4. Intersect from the rarest word on: its postings, shifted by the distance of the next rarest word, must meet that
   word's postings, then those of the third. Phrases that share two words at one distance (as neighbouring windows of an
   item do) are one lookup up to the third word.
5. What is left is compared with the whole phrase in the texts that still have a candidate; only these are read again.

Words are looked up by a 64-bit hash and texts are named by one; the last step compares the words themselves, so a
collision costs a comparison and never a result. Equal texts have their postings once. Terms and phrases are broadcast
up to SEND_ROWS rows; a larger benchmark is joined by shuffles.

Proximity matches have at least a given share of the phrase's distinct words within one window's length of one of its
rarest words, in any order; enough of the rarest words are looked up that one of them must be there. They may have words
that no text has.

Defined cases: a null text has no words; an item without words or id has no phrases; items with one id count as one
item; rows with one doc_id stay separate rows; an empty benchmark leaves every document clean; further columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graylane.llm.common import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most rows of terms (16 bytes each) or phrases (about 200) that are broadcast.
SEND_ROWS = {"terms": 2_000_000, "phrases": 200_000, "texts": 1_000_000}
RARE = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; lower() does just that where all characters are ASCII."""
    plain = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(F.coalesce(plain, F.lit("")), F.lit(WORD), F.lit(0))


def sent(df: DataFrame, kind: str) -> DataFrame:
    """df for the build side of a join: broadcast if its count is within the bound for its kind."""
    return F.broadcast(df) if df.limit(SEND_ROWS[kind] + 1).count() <= SEND_ROWS[kind] else df


def item_phrases(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(pid, phrase, len) of the distinct phrases, and (pid, item_id) of the items that have them."""
    w = benchmark.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    each = written(w.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("phrase")).distinct(), "decon-windows")
    phrases = written(each.select("phrase").distinct().select(F.monotonically_increasing_id().alias("pid"), "phrase", F.size("phrase").alias("len")), "decon-phrases")
    return phrases, written(each.join(phrases, "phrase").select("pid", "item_id"), "decon-items")


def with_rare(phrases: DataFrame, texts: DataFrame, rare: int) -> DataFrame:
    """phrases with freq (of its rarest word) and terms: (freq, place, tid) of its rarest words, rarest first, `rare` of them."""
    terms = written(phrases.select("pid", F.posexplode("phrase").alias("place", "word")).select("pid", "place", F.xxhash64("word").alias("tid")), "decon-terms")
    vocabulary = terms.select("tid").distinct()
    counts = texts.select(F.explode("w").alias("word")).select(F.xxhash64("word").alias("tid")).join(sent(vocabulary, "terms"), "tid").groupBy("tid").agg(F.count(F.lit(1)).alias("freq"))
    counts = written(counts, "decon-counts")
    found = terms.join(sent(counts, "terms"), "tid", "left").groupBy("pid").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "place", "tid"))).alias("terms"))
    found = found.select("pid", F.col("terms")[0]["freq"].alias("freq"), F.slice("terms", 1, rare).alias("terms"))
    return written(phrases.join(found, "pid"), "decon-rare")


def postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, h, tid, pos) of the terms (tid) in the texts; an empty word at the end of each text has its number of words as pos."""
    keys = terms.select("tid").distinct().unionByName(texts.sparkSession.sql("select xxhash64('') as tid"))
    posted = texts.select("doc_id", "h", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word")).select("doc_id", "h", "pos", F.xxhash64("word").alias("tid"))
    return written(posted.join(sent(keys, "terms"), "tid"), "decon-postings")


def phrase_candidates(phrases: DataFrame, posts: DataFrame) -> DataFrame:
    """(h, pid, start): where the three rarest words of a phrase stand at their distances."""
    at = lambda k: F.get("terms", F.least(F.lit(k), F.size("terms") - 1))
    p = phrases.filter("freq > 0").select("pid", "len", *[at(k)["tid"].alias(f"tid{k}") for k in range(3)], *[at(k)["place"].alias(f"place{k}") for k in range(3)])
    p = p.withColumn("step", F.col("place1") - F.col("place0"))
    pairs = p.select("tid0", "tid1", "step").distinct()
    first = posts.withColumnRenamed("tid", "tid0").join(sent(pairs, "phrases"), "tid0").withColumn("there", F.col("pos") + F.col("step"))
    lists = posts.select("h", F.col("tid").alias("tid_x"), F.col("pos").alias("pos_x"))
    meet = lambda df, tid: df.join(lists, (df["h"] == lists["h"]) & (df[tid] == lists["tid_x"]) & (df["there"] == lists["pos_x"]), "left_semi")
    first = written(meet(first, "tid1").drop("there"), "decon-met")
    third = first.join(sent(p, "phrases"), ["tid0", "tid1", "step"]).withColumn("start", F.col("pos") - F.col("place0")).withColumn("there", F.col("start") + F.col("place2"))
    return meet(third.filter("start >= 0"), "tid2").select("h", "pid", "start")


def near_candidates(phrases: DataFrame, posts: DataFrame) -> DataFrame:
    """(h, pid, start): from where on a window's length of words around one of the rarest words of a phrase stands."""
    terms = phrases.select("pid", F.col("len"), F.explode("terms").alias("t")).select("pid", "len", F.col("t.tid").alias("tid"))
    return posts.join(sent(terms, "phrases"), "tid").select("h", "pid", F.greatest(F.lit(0), F.col("pos") - F.col("len") + 1).alias("start"))


def located(texts: DataFrame, phrases: DataFrame, candidates: DataFrame, near_share: float | None) -> DataFrame:
    """(doc_id, h, pid, start, len, shared) of the candidates that the texts' own words confirm."""
    by_text = written(candidates.groupBy("h").agg(F.collect_set(F.struct("pid", "start")).alias("at")), "decon-candidates")
    rows = texts.join(sent(by_text, "texts"), "h").select("doc_id", "h", "w", F.explode("at").alias("at")).select("doc_id", "h", "w", "at.*")
    rows = rows.join(sent(phrases.select("pid", "phrase", "len"), "phrases"), "pid")
    if near_share is None:
        return rows.filter(F.slice("w", F.col("start") + 1, F.col("len")) == F.col("phrase")).select("doc_id", "h", "pid", "start", "len", F.size(F.array_distinct("phrase")).alias("shared"))
    shared = F.size(F.array_intersect(F.slice("w", F.col("start") + 1, 2 * F.col("len") - 1), "phrase"))
    rows = rows.select("doc_id", "h", "pid", "start", "len", shared.alias("shared"), F.size(F.array_distinct("phrase")).alias("n"))
    return rows.filter(F.col("shared") >= near_share * F.col("n")).drop("n")


def index_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 13, near_share: float | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes: doc_id, h, n_words of each row of docs; matches: doc_id, h, pid, start, len, shared; items: pid, item_id).

    Without near_share the matches are exact; with it they are the proximity matches, exact ones among them, where start is
    that of the stretch of words that was compared.
    """
    phrases, items = item_phrases(benchmark, item_col, item_text, window)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), words(F.col(text_col)).alias("w"))
    missing = 0 if near_share is None else window - math.ceil(near_share * window)
    rare = with_rare(phrases, texts, max(RARE, missing + 1))
    looked_up = rare if near_share is not None else rare.filter("freq > 0")
    posted = postings(texts, looked_up.select(F.explode("terms.tid").alias("tid")))
    end = F.col("tid") == F.xxhash64(F.lit(""))
    sizes = posted.filter(end).select("doc_id", "h", F.col("pos").cast("long").alias("n_words"))
    posts = written(posted.filter(~end).select("h", "tid", "pos").distinct(), "decon-lists")
    candidates = phrase_candidates(rare, posts) if near_share is None else near_candidates(rare, posts)
    return sizes, located(texts, phrases, candidates, near_share), items


def decontaminate(docs: DataFrame, benchmark: DataFrame, least_share: int = 20, **names) -> DataFrame:
    """For each row of docs: doc_id, h (hash of its text), n_words, n_hit (words inside an occurrence of a window), items, contaminated."""
    sizes, matches, items = index_matches(docs, benchmark, **names)
    matches = written(matches.select("doc_id", "h", "pid", "start", "len").distinct(), "decon-matches")
    spans = matches.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("spans"))
    hit = F.expr("aggregate(spans, struct(0L as n, 0L as upto), (a, s) -> named_struct('n', a.n + greatest(0L, s.end - greatest(a.upto, cast(s.start as bigint))), 'upto', greatest(a.upto, cast(s.end as bigint)))).n")
    named = matches.select("doc_id", "h", "pid").distinct().join(sent(items, "phrases"), "pid").groupBy("doc_id", "h").agg(F.collect_set("item_id").alias("ids"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])
    found = spans.join(named, same(spans, named)).select(spans["doc_id"], spans["h"], hit.alias("n_hit"), F.sort_array(F.transform("ids", lambda i: i.cast("string"))).alias("items"))
    found = written(found, "decon-found")
    out = sizes.join(found, same(sizes, found), "left").select(sizes["doc_id"], sizes["h"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * least_share >= F.col("n_words")))
