"""Quality: votes of the nearest labelled texts in a latent semantic space.

Terms are hashed words, word shapes (kinds of the first and last characters, length) and pairs of neighbouring shapes or
a repeated word. A bounded sample of labelled rows, PER_LABEL of each label, gives term weights (log count times inverse
document frequency) and, by subspace iteration, LATENT singular directions. The labelled rows' latent vectors go to all
executors; each text's vector is compared with all of them by exact cosine, in blocks, and its NEIGHBOURS nearest vote
with the square of their similarity, each label weighted back to its share among all labelled rows.

Defined cases: null and empty texts, and texts of unknown terms alone, score the share of label 1; a null doc_id is not
held out; with labels of one kind only, every score is that label; without labels every score is 0; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C
from graylane.llm.training import bounded_sample, product, score_texts, sparse_counts

WORDS, SHAPES = 1 << 15, 1 << 14
PER_LABEL, LATENT, NEIGHBOURS, ITERATIONS = 1500, 64, 25, 3
#: Kinds of bytes: letters a, capitals A, digits 9; every other character stands for itself.
KIND = np.arange(256, dtype=np.uint8)
KIND[ord("a") : ord("z") + 1] = ord("a")
KIND[0x80:] = ord("a")
KIND[ord("A") : ord("Z") + 1] = ord("A")
KIND[ord("0") : ord("9") + 1] = ord("9")


def terms(column: pa.Array):
    """(first row, rows, document, term, count) for pieces of texts, in the order of document and term."""
    for i, j, text, at in C.pieces(column):
        start, end, before = C.word_spans(text, at, C.NON_SPACE)
        doc = np.repeat(np.arange(j - i), np.diff(before))
        word = C.span_hashes(C.LOWER[text], start, end)
        kind = KIND[text].astype(np.uint64) if len(text) else np.zeros(1, np.uint64)
        last = np.maximum(end - 1, 0)
        shape = kind[start] | kind[last] << np.uint64(8) | kind[np.maximum(last - 1, start)] << np.uint64(16) | kind[np.maximum(last - 2, start)] << np.uint64(24) | np.minimum(end - start, 12).astype(np.uint64) << np.uint64(32)
        shape = C.mixed(shape)
        pair = np.flatnonzero(doc[1:] == doc[:-1])
        again = word[pair] == word[pair + 1]
        joint = np.where(again, np.uint64(1), C.mixed(shape[pair] * np.uint64(31) + shape[pair + 1]))
        d = np.concatenate([doc, doc, doc[pair]])
        t = np.concatenate([(word % np.uint64(WORDS)).astype(np.int64), WORDS + (shape % np.uint64(SHAPES)).astype(np.int64), WORDS + SHAPES + (joint % np.uint64(SHAPES)).astype(np.int64)])
        yield i, j - i, *sparse_counts(d, t, WORDS + 2 * SHAPES)


class NearestVotes:
    """idf and v: the latent space; known: latent vectors of labelled rows; labels and their weights."""

    def __init__(self, idf, v, known, labels, weight, share):
        self.idf, self.v, self.known, self.labels, self.weight, self.share = idf, v, known, labels, weight, share

    @staticmethod
    def weighted(doc, term, n, rows, idf):
        value = (np.log1p(n) * idf[term]).astype(np.float32)
        norm = np.sqrt(np.bincount(doc, value * value, rows))
        return value / np.maximum(norm, 1e-9)[doc].astype(np.float32)

    @staticmethod
    def unit(x):
        return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)

    @classmethod
    def fit(cls, texts: list[str], labels: np.ndarray, share: float, seed: int = 11) -> NearestVotes:
        width, rows = WORDS + 2 * SHAPES, len(texts)
        parts = [((d + first).astype(np.int32), t.astype(np.int32), n.astype(np.int32)) for first, _, d, t, n in terms(pa.array(texts, pa.string()))]
        doc, term, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        df = np.bincount(term, minlength=width)
        idf = np.where(df > 1, np.log((1 + rows) / (1 + df)) + 1, 0.0)
        keep = idf[term] > 0
        doc, term, n = doc[keep], term[keep], n[keep]
        value = cls.weighted(doc, term, n, rows, idf)
        by_term = np.argsort(term, kind="stable")
        t_doc, t_term, t_value = doc[by_term], term[by_term], value[by_term]
        rng = np.random.Generator(np.random.PCG64(seed))
        q = rng.standard_normal((width, min(LATENT, rows))).astype(np.float32)
        for _ in range(ITERATIONS):
            y = product(doc, term, value, q, rows)
            y, _ = np.linalg.qr(y)
            q = product(t_term, t_doc, t_value, y, width)
            q = np.linalg.qr(q)[0].astype(np.float32)
        known = cls.unit(product(doc, term, value, q, rows))
        of = labels.mean()
        weight = np.where(labels == 1, share / of, (1 - share) / (1 - of))
        return cls(idf, q, known.astype(np.float32), labels, weight, share)

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.share)
        k = min(NEIGHBOURS, len(self.known))
        for first, rows, doc, term, n in terms(column):
            keep = self.idf[term] > 0
            doc, term, n = doc[keep], term[keep], n[keep]
            value = self.weighted(doc, term, n, rows, self.idf)
            x = self.unit(product(doc, term, value, self.v, rows))
            some = np.flatnonzero((x * x).sum(1) > 0.5)
            for s in range(0, len(some), 256):
                at = some[s : s + 256]
                cosine = x[at] @ self.known.T
                near = np.argpartition(cosine, -k, axis=1)[:, -k:]
                w = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** 2 * self.weight[near]
                # a tenth of a vote for the shares keeps a score defined when no neighbour is similar
                out[first + at] = ((w * self.labels[near]).sum(1) + 0.1 * self.share) / (w.sum(1) + 0.1)
        return out


def fit(labelled: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_label: int = PER_LABEL):
    """A function from texts to scores. labelled: doc_id and label (0, 1) of the rows to learn from."""
    shares = {r.label: r["count"] for r in labelled.filter("label in (0, 1)").groupBy("label").count().collect()}
    if len(shares) < 2:
        only = float(next(iter(shares), 0))
        return lambda column: np.full(len(column), only)
    sample = bounded_sample(labelled.filter("label in (0, 1)"), docs, per_label, id_col, text_col)
    labels = sample["label"].to_numpy().astype(int)
    share = shares[1] / (shares[0] + shares[1])
    if len(set(labels)) < 2:
        return lambda column: np.full(len(column), share)
    return NearestVotes.fit(sample["text"].tolist(), labels, share).score


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fold: int = 5, held: int = 0, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs; learnt from the rows of labels whose fold isn't held."""
    C.prepare_python(docs.sparkSession)
    learn = labels.filter(C.crc_mod(id_col, fold) != held).select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    return score_texts(docs, fold, held, id_col, text_col, fit(learn, docs, id_col, text_col), threshold)
