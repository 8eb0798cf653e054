"""Bounded samples of labelled rows to fit on, and the loop that scores every text in Spark's tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C

#: A row longer than this isn't used to fit on, so that a sample's size is bounded; every row is scored whole.
FIT_BYTES = 20_000
#: The scored text's column, beside which any columns may be kept.
TEXT = "scored_text"


def bounded_sample(labelled: DataFrame, docs: DataFrame, per_label: int, id_col: str, text_col: str) -> pd.DataFrame:
    """doc_id, text, label: at most per_label rows of each label of labelled (doc_id, label), the ones with the least hash of the id.

    Two passes over ids and labels alone pick the rows; then only their texts are read.
    """
    labelled = labelled.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    labelled = labelled.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30))
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    picked = labelled.join(counts, "label").filter(F.col("h") * F.col("n") <= 1.2 * per_label + 20)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= FIT_BYTES)
    # about 1.2 * per_label ids of each label; of rows with one id the least text, so that ids bound the rows
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label", "h").agg(F.min("text").alias("text")).toArrow().to_pandas()
    rows = rows.sort_values(["h", "doc_id"])
    return rows.groupby("label", group_keys=False).head(per_label).reset_index(drop=True)


def score_texts(docs: DataFrame, fold: int, held: int, id_col: str, text_col: str, score: Callable[[pa.Array], np.ndarray], threshold: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted and the columns of keep for every row; score maps a batch of texts to numbers from 0 to 1."""
    C.prepare_python(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(C.crc_mod(id_col, fold) == held, F.lit(False)).alias("held_out"), F.col(text_col).alias(TEXT), *keep)
    kept = "".join(f", `{c}` {t}" for c, t in docs.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.clip(score(batch.column(TEXT)), 0.0, 1.0) if batch.num_rows else np.zeros(0)
            out = [batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32)), *[batch.column(c) for c in keep]]
            yield pa.record_batch(out, names=["doc_id", "held_out", "score", "predicted", *keep])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int{kept}")


def sparse_counts(doc: np.ndarray, feature: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, feature, count) of the distinct pairs, in order."""
    key, n = np.unique(doc.astype(np.int64) * width + feature, return_counts=True)
    return key // width, key % width, n


def row_sums(values: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the rows of values (in the order of doc) for each doc."""
    out = np.zeros((rows, *values.shape[1:]), values.dtype)
    if len(doc):
        at = np.r_[0, np.flatnonzero(np.diff(doc)) + 1]
        out[doc[at]] = np.add.reduceat(values, at, axis=0)
    return out


def product(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, dense: np.ndarray, n: int, step: int = 100_000) -> np.ndarray:
    """The sparse matrix (rows in order, cols, values) of n rows times dense, a bounded number of entries at once."""
    out = np.zeros((n, dense.shape[1]), np.float32)
    for k in range(0, len(rows), step):
        r = rows[k : k + step]
        at = np.r_[0, np.flatnonzero(np.diff(r)) + 1]
        out[r[at]] += np.add.reduceat(dense[cols[k : k + step]] * values[k : k + step, None], at, axis=0)
    return out
