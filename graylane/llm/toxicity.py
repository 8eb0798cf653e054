"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

The features of a text are its distinct words and their character n-grams of 3 to 5 bytes with marked word ends, hashed into
BUCKETS rows of an embedding; a misspelling shares most n-grams with the word it comes from. The average of a text's
embeddings, weighted by their rarity (log of texts over texts with the feature) and divided by the root of the squared
weights, goes through a linear softmax; both are trained by Adagrad on a bounded sample, PER_LABEL rows of each label.
Scores of texts by models that have not seen them, weighted to the shares of the labels among all labelled rows, set the
scale. Because the model is linear behind the average, a bucket's part in the logit is one number, and scoring every text
needs two tables of BUCKETS numbers.

Defined cases: null and empty texts have no features and score the share of label 1; a null doc_id is not held out;
with labels of one kind only, every score is that label; without labels every score is 0; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C
from graylane.llm.training import bounded_sample, row_sums, score_texts, sparse_counts

BUCKETS, DIM, GRAMS = 1 << 18, 4, (3, 4, 5)
#: At least UPDATES steps are made, however small the sample; FOLDS models on parts of it set the scale of the logit.
PER_LABEL, EPOCHS, UPDATES, BATCH, RATE, DECAY, FOLDS, FIT_PIECE = 1500, 10, 100, 64, 0.5, 1e-4, 3, 1 << 17


def subwords(column: pa.Array, piece: int = C.PIECE_BYTES):
    """(first row, rows, document of each feature, its bucket) for pieces of texts."""
    for i, j, text, at in C.pieces(column, piece):
        n = np.diff(at)
        doc = np.repeat(np.arange(j - i), n)
        padded = np.full(len(text) + j - i + 1, 0x20, np.uint8)  # a space before, between and after the texts
        padded[np.arange(len(text)) + doc + 1] = C.LOWER[text]
        of = np.full(len(padded), -1, np.int64)
        of[np.arange(len(text)) + doc + 1] = doc
        inside = C.ALNUM[padded]
        padded[~inside] = 0x20
        total = np.r_[np.uint64(0), np.cumsum(C.BYTE_VALUE[padded] * C.powers(C.BASE, len(padded)))]
        back = C.powers(C.BASE_INV, len(padded) + 1)
        ends = np.r_[0, np.cumsum(~inside)]
        start, end = np.flatnonzero(inside & ~np.r_[False, inside[:-1]]), np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
        word = C.mixed((total[end] - total[start]) * back[start])
        # a word counts once in a text, however often it stands there
        order = np.lexsort((word, of[start]))
        new = np.ones(len(order), bool)
        new[1:] = (word[order][1:] != word[order][:-1]) | (of[start][order][1:] != of[start][order][:-1])
        kept = np.zeros(len(start), bool)
        kept[order[new]] = True
        mark = np.zeros(len(padded) + 1, np.int8)
        mark[start[kept]] = 1
        mark[end[kept]] = -1
        counted = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
        docs, features = [of[start[kept]]], [word[kept] % np.uint64(BUCKETS)]
        for g in GRAMS:
            s = np.flatnonzero(counted[1 : len(padded) - g + 2])
            s = s[ends[s + g - 1] == ends[s + 1]]  # only the first and the last byte may be a word's end
            docs.append(of[s + 1])
            features.append(C.mixed((total[s + g] - total[s]) * back[s] + np.uint64(g)) % np.uint64(BUCKETS))
        yield i, j - i, np.concatenate(docs), np.concatenate(features).astype(np.int64)


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the weighted logistic regression of y on z (Newton's method, a little ridge)."""
    spread = z.std() or 1.0
    x = np.stack([(z - z.mean()) / spread, np.ones(len(z))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-2 * beta
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta -= np.clip(np.linalg.solve(h, g), -2, 2)
    return float(beta[0] / spread), float(beta[1] - beta[0] * z.mean() / spread)


class SubwordSoftmax:
    """rarity: a bucket's weight in the average (0: left out); weight: rarity times its part in the logit of label 1; scale and bias: from the average to the logit."""

    def __init__(self, rarity: np.ndarray, weight: np.ndarray, bias: float = 0.0, scale: float = 1.0):
        self.rarity, self.square, self.weight, self.bias, self.scale = rarity, rarity * rarity, weight, bias, scale

    @classmethod
    def fit(cls, texts: list[str], labels: np.ndarray, share: float, seed: int = 7) -> SubwordSoftmax:
        """share: the share of label 1 among all labelled rows, whatever it is in the sample.

        FOLDS models, each without one fold of the sample, score the texts that they have not seen: these scores set scale
        and bias of the model that is trained on all.
        """
        rng = np.random.Generator(np.random.PCG64(seed))
        order = rng.permutation(len(texts))
        labels = np.asarray(labels)
        bags = Bags(texts)
        fold = np.empty(len(texts), np.int64)
        for y in (0, 1):  # each fold has its share of either label
            own = order[labels[order] == y]
            fold[own] = np.arange(len(own)) % FOLDS
        unseen = np.zeros(len(texts))
        for k in range(FOLDS):
            rest, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(set(labels[rest])) == 2:
                part = train(bags, rest, labels, rng)
                unseen[out] = [part.average(*bags.of(i)) for i in out]
        model = train(bags, np.arange(len(texts)), labels, rng)
        of = labels.mean()
        prior = np.where(labels == 1, share / of, (1 - share) / (1 - of))
        model.scale, model.bias = platt(unseen, labels, prior)
        return model

    def average(self, features: np.ndarray, counts: np.ndarray) -> float:
        """The logit of one bag before scale and bias."""
        return float(counts @ self.weight[features] / np.sqrt(max(counts @ self.square[features], 1e-9)))

    def averages(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for first, rows, d, f in subwords(column):
            out[first : first + rows] = np.bincount(d, self.weight[f], rows) / np.sqrt(np.maximum(np.bincount(d, self.square[f], rows), 1e-9))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.averages(column) * self.scale + self.bias, -50, 50)))


class Bags:
    """The features of texts with their counts, in narrow types: this stands on the driver, about 12 MB for 1000 texts."""

    def __init__(self, texts: list[str]):
        feats, counts, sizes = [], [], []
        for k in range(0, len(texts), BATCH):
            for _, rows, d, f in subwords(pa.array(texts[k : k + BATCH], pa.string()), FIT_PIECE):
                d, f, n = sparse_counts(d, f, BUCKETS)
                feats.append(f.astype(np.int32))
                counts.append(np.minimum(n, 255).astype(np.uint8))
                sizes.append(np.bincount(d, minlength=rows))
        self.feats, self.counts = np.concatenate(feats), np.concatenate(counts)
        self.at = np.r_[0, np.cumsum(np.concatenate(sizes))]

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.feats[self.at[i] : self.at[i + 1]], self.counts[self.at[i] : self.at[i + 1]].astype(np.float32)


def train(bags: Bags, rows: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> SubwordSoftmax:
    """Embeddings and softmax trained jointly on the given rows of the sample, both labels with the same weight in sum."""
    df = np.zeros(BUCKETS, np.int64)
    for i in rows:
        df[bags.of(i)[0]] += 1
    # what a single text (or one of 600) has would only learn this text by heart
    rarity = np.where(df >= max(2, len(rows) // 600), np.log((len(rows) + 1) / np.maximum(df, 1)), 0.0).astype(np.float32)
    there = np.zeros(BUCKETS, bool)
    e = rng.normal(0, 0.02 / DIM, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    w[:, 1], w[:, 0] = 0.5, -0.5
    g_e, g_w, g_b = np.full((BUCKETS, 1), 1e-8, np.float32), np.full_like(w, 1e-3), np.full_like(b, 1e-3)
    y = np.eye(2, dtype=np.float32)[labels]
    own_share = labels[rows].mean()
    each = np.where(labels == 1, 0.5 / own_share, 0.5 / (1 - own_share)).astype(np.float32)
    epochs = max(EPOCHS, UPDATES * BATCH // max(1, len(rows)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(rows)
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            found = [bags.of(i) for i in batch]
            own = np.repeat(np.arange(len(batch)), [len(f) for f, _ in found])
            f, n = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = rarity[f] > 0
            own, f, n = own[keep], f[keep], n[keep]
            if not len(f):
                continue
            v = n * rarity[f]
            v /= np.sqrt(np.bincount(own, v * rarity[f], len(batch)).astype(np.float32))[own]
            h = row_sums(e[f] * v[:, None], own, len(batch))
            z = h @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - y[batch]) * each[batch, None] / len(batch)
            back = d @ w.T
            there[f] = True
            f_u = np.flatnonzero(there)
            there[f_u] = False
            grad = np.stack([np.bincount(f, back[own, c] * v, BUCKETS)[f_u] for c in range(DIM)], 1).astype(np.float32) + DECAY * e[f_u]
            g_e[f_u] += (grad * grad).mean(1, keepdims=True)
            e[f_u] -= rate * grad / np.sqrt(g_e[f_u])
            gw, gb = h.T @ d, d.sum(0)
            g_w += gw * gw
            g_b += gb * gb
            w -= 0.1 * rate * gw / np.sqrt(g_w)
            b -= 0.1 * rate * gb / np.sqrt(g_b)
    weight = np.where(rarity > 0, rarity * (e @ (w[:, 1] - w[:, 0])), 0.0).astype(np.float32)
    return SubwordSoftmax(rarity, weight)


def fit(labelled: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_label: int = PER_LABEL):
    """A function from texts to scores. labelled: doc_id and label (0, 1) of the rows to learn from."""
    shares = {r.label: r["count"] for r in labelled.filter("label in (0, 1)").groupBy("label").count().collect()}
    if len(shares) < 2:
        only = float(next(iter(shares), 0))
        return lambda column: np.full(len(column), only)
    sample: pd.DataFrame = bounded_sample(labelled.filter("label in (0, 1)"), docs, per_label, id_col, text_col)
    labels = sample["label"].to_numpy().astype(int)
    share = shares[1] / (shares[0] + shares[1])
    if len(set(labels)) < 2:
        return lambda column: np.full(len(column), share)
    return SubwordSoftmax.fit(sample["text"].tolist(), labels, share).score


def scored(docs: DataFrame, score, fold: int = 4, held: int = 2, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted and the columns of keep for each row of docs by a fitted score."""
    return score_texts(docs, fold, held, id_col, text_col, score, threshold, keep)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", fold: int = 4, held: int = 2, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs; learnt from the rows of labels whose fold isn't held."""
    C.prepare_python(docs.sparkSession)
    learn = labels.filter(C.crc_mod(id_col, fold) != held).select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    return scored(docs, fit(learn, docs, id_col, text_col), fold, held, threshold, id_col, text_col)
