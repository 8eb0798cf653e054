"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, token ids.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graylane.llm import decontaminate, jaccard_join, mixing, token_output, toxicity
from graylane.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows of decisions (a hash of eight bytes, at most a source and a number beside it) that are sent to all tasks, so that texts stay where they are; beyond it texts and decisions meet by a shuffle.
SEND_ROWS = 1_000_000


def sent(decisions: DataFrame) -> DataFrame:
    """Written decisions for the build side of a join: broadcast if there are at most SEND_ROWS."""
    return F.broadcast(decisions) if decisions.count() <= SEND_ROWS else decisions


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, learnt from the labels, doesn't predict toxic. Each row is decided on by its own text, with an id or without, and goes through the classifier whole; a null or empty text is decided on by the share of toxic labels."""
    known = toxicity.fit(table(spark, sf_dir, "labels").selectExpr("doc_id", "toxic as label"), docs)
    return toxicity.scored(docs.select(*COLUMNS), known, keep=COLUMNS[1:]).filter("predicted = 0").select(*COLUMNS)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose id and text are among gone (doc_id, h: the hash of the text)."""
    rows = docs.withColumn("h", F.xxhash64("text"))
    gone = sent(gone)
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["h"] == gone["h"]), "left_anti").select(*COLUMNS)


def least(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows with equal keys the one whose other columns are the least (null first), in the order of COLUMNS."""
    others = [c for c in COLUMNS if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("least")).select(*keys, "least.*").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id (null last), once; of rows with that id and text the least by their other columns; rows without words are in no group and stay."""
    found = written(jaccard_join.representatives(docs), "representatives")
    rows = docs.select(*COLUMNS).withColumn("rk", F.xxhash64(F.col("doc_id").cast("long"), "text"))
    kept = rows.join(sent(written(found.filter("not kept").select("rk").distinct(), "near-copies")), "rk", "left_anti")
    twice = written(found.filter("kept and rows > 1").select("rk").distinct(), "repeated-rows")
    if twice.isEmpty():
        return kept.select(*COLUMNS)
    return kept.join(twice, "rk", "left_anti").select(*COLUMNS).unionByName(least(kept.join(twice, "rk", "left_semi"), ["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which the benchmark's windows hold less than a twentieth of the words, with an id or without; a row without words stays."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, written(found.filter("contaminated").select("doc_id", "h").distinct(), "contaminated-rows"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; the copies are rows with the same doc_id. Of rows with one id, text and source the least stands for the sum of what the mix takes of them."""
    rows = docs.select(*COLUMNS).withColumn("h", F.xxhash64("doc_id", "text"))
    found = mixing.mix_alike(rows)
    taken = written(found.groupBy("h", "source").agg(F.sum(F.col("copies") * F.col("rows")).cast("int").alias("copies"), F.sum("rows").alias("rows")).filter("copies > 0"), "mixed-rows")
    same = lambda a, b: (a["h"] == b["h"]) & a["source"].eqNullSafe(b["source"])
    once, taken = taken.filter("rows > 1").select("h", "source"), sent(taken)
    if not once.isEmpty():
        rows = rows.join(once, same(rows, once), "left_anti").unionByName(least(rows.join(once, same(rows, once), "left_semi"), ["doc_id", "text", "source"]).withColumn("h", F.xxhash64("doc_id", "text")))
    return rows.join(taken, same(rows, taken)).select(*[rows[c] for c in COLUMNS], F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids in shards, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_output.read_tokens(token_output.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", write_ids),
]

#: Classifiers, rounding by hashes and tokenizers are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
