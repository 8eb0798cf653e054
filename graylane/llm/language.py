"""Language id by cross-parsing entropy.

For each language a suffix automaton of labelled text (at most SYMBOLS symbols of whole rows) recognises every string that
the text holds. A text is parsed against each: the longest match, then the next from where it ended. The fewer phrases a
language needs, times the bits of a pointer into its text, the better it predicts the text; the language with the fewest
bits a symbol wins.

Symbols are lower-case bytes of letters; everything else is one separator. The automata stand behind each other in one
table of transitions, and many texts are parsed at once, a symbol of each in a step; every text is parsed whole.

Defined cases: `und` with score 0 if a text is null or has no letter, or if there is nothing to learn from; of languages
with equal bits the first by name wins; a null doc_id is not held out; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C
from graylane.llm.training import bounded_sample

SYMBOLS, ROWS = 20_000, 300
#: Bytes of texts parsed at once, and so many of the longest are finished one by one.
PIECE, FEW = 1 << 24, 24
#: Letters keep their bytes (all bytes of other scripts count as letters), everything else is a separator.
LETTERS = C.LOWER.copy()
LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def plain(text: np.ndarray) -> np.ndarray:
    """Symbols of a text's bytes, with one separator for neighbouring ones."""
    s = LETTERS[text]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0x20) | (s[:-1] != 0x20)
    return s[keep]


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions (state, symbol) of the automaton of all substrings; 0 is the start, -1 no transition."""
    most = 2 * len(symbols) + 1
    go = np.full((most, width), -1, np.int32)
    link, length, states, last = [-1] * most, [0] * most, 1, 0
    for s in symbols:
        cur, states = states, states + 1
        length[cur] = length[last] + 1
        p = last
        while p >= 0 and go[p, s] < 0:
            go[p, s] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        elif length[p] + 1 == length[q := int(go[p, s])]:
            link[cur] = q
        else:
            copy, states = states, states + 1
            go[copy], link[copy], length[copy] = go[q], link[q], length[p] + 1
            while p >= 0 and go[p, s] == q:
                go[p, s] = copy
                p = link[p]
            link[q] = link[cur] = copy
        last = cur
    return go[:states]


class CrossParser:
    """languages in order; code: a byte's symbol (0 for unknown ones); go: all automata's transitions; starts; bits of a phrase."""

    def __init__(self, samples: dict[str, list[bytes]], symbols: int = SYMBOLS):
        self.languages = sorted(samples)
        texts = {}
        for name in self.languages:
            parts, size = [], 0
            for raw in samples[name]:
                s = plain(np.frombuffer(raw, np.uint8))
                if size and size + len(s) > symbols:
                    continue
                parts += [s, np.array([0x20], np.uint8)]
                size += len(s) + 1
            texts[name] = np.concatenate(parts) if parts else np.array([0x20], np.uint8)
        known = np.unique(np.concatenate([*texts.values(), [0x20]]))
        self.code = np.zeros(256, np.int32)
        self.code[known] = 1 + np.arange(len(known))
        self.width = len(known) + 1
        tables, self.starts, at = [], [], 0
        for name in self.languages:
            go = suffix_automaton(self.code[texts[name]].tolist(), self.width)
            tables.append(np.where(go >= 0, go + at, -1))
            self.starts.append(at)
            at += len(go)
        self.go = np.concatenate(tables).astype(np.int32).ravel()
        self.bits = np.array([np.log2(len(texts[name]) + 1) for name in self.languages])

    def phrases(self, symbols: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each text (its symbols stand from begin on) for each language: a symbol of every text in a step, and what only a few long texts have left one after the other."""
        n, k = len(begin), len(self.languages)
        order = np.argsort(-lengths, kind="stable")
        begin, lengths = begin[order], lengths[order]
        start = np.repeat(np.array(self.starts, np.int32), n).reshape(k, n)
        state, count = start.copy(), (lengths > 0).astype(np.int64) * np.ones((k, 1), np.int64)
        common = int(lengths[FEW]) if n > FEW else 0
        active = np.searchsorted(-lengths, -np.arange(common), "left")  # texts longer than each step
        for step in range(common):
            m = active[step]
            s = symbols[begin[:m] + step]
            now, base = state[:, :m], start[:, :m]
            to = self.go[now * self.width + s]
            ends = to < 0
            # a new phrase begins with this symbol, unless the one that ended was still empty
            count[:, :m] += ends & (now != base)
            again = self.go[base * self.width + s]
            to = np.where(ends, np.where(again < 0, base, again), to)
            count[:, :m] += ends & (again < 0)  # a symbol that the language doesn't have is a phrase of its own
            state[:, :m] = to
        go, width = memoryview(self.go), self.width
        for i in range(min(n, FEW)):
            rest = symbols[begin[i] + common : begin[i] + lengths[i]].tolist()
            for j, base in enumerate(self.starts):
                at, new = int(state[j, i]), 0
                for s in rest:
                    to = go[at * width + s]
                    if to < 0:
                        new += at != base
                        to = go[base * width + s]
                        if to < 0:
                            new, to = new + 1, base
                    at = to
                count[j, i] += new
        out = np.empty((n, k), np.int64)
        out[order] = count.T
        return out

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language, score) of each text."""
        best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
        for i, j, text, at in C.pieces(column, PIECE):
            s = LETTERS[text]
            keep = np.ones(len(s), bool)
            keep[1:] = (s[1:] != 0x20) | (s[:-1] != 0x20)
            cuts = np.searchsorted(np.flatnonzero(keep), at)
            n = np.diff(cuts)
            bits = self.phrases(self.code[s[keep]], cuts[:-1], n) * self.bits
            best[i:j] = bits.argmin(1)
            less = (bits - bits.min(1, keepdims=True)) / np.sqrt(np.maximum(n, 1))[:, None]
            score[i:j] = 1 / np.exp2(-np.minimum(less, 60)).sum(1)
        return best, score


def predict_language(docs: DataFrame, fold: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row; learnt from rows with a language whose fold isn't held."""
    C.prepare_python(docs.sparkSession)
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    learn = docs.filter(C.crc_mod(id_col, fold) != held).select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("label"))
    sample: pd.DataFrame = bounded_sample(learn, docs.filter(letters), rows, id_col, text_col)
    parser = CrossParser({k: [t.encode() for t in g["text"]] for k, g in sample.groupby("label")}) if len(sample) else None
    rows_ = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(C.crc_mod(id_col, fold) == held, F.lit(False)).alias("held_out"), letters.alias("letters"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = batch.column("letters").to_numpy(zero_copy_only=False)
            if parser is None or not batch.num_rows:
                names, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            else:
                best, score = parser.predict(batch.column("text"))
                names = np.where(ok, np.array(parser.languages, object)[best], "und")
                score = np.where(ok, score, 0.0)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows_.mapInArrow(run, f"doc_id {dict(rows_.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
