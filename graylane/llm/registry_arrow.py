"""Queries of the operators that work on Arrow batches inside Spark's tasks, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from graylane.llm import embedding_dedup, jaccard_join, language, quality, token_output, toxicity
from graylane.llm.common import table


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return language.predict_language(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents linked at a shingle similarity of 0.8."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in shards, read back."""
    return token_output.read_tokens(token_output.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for toxicity."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at a cosine of 0.95."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op2_quality": op2_quality, "op3_language": op3_language, "op10_toxicity": op10_toxicity, "op5_jaccard_join": op5_jaccard_join, "op7_token_output": op7_token_output, "op8_embedding_dedup": op8_embedding_dedup}

_PLAIN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op5_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_PLAIN}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.reach)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(reach) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id, n
""",
}
