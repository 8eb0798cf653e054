"""Periodic runs of words: suffix trees of a text and its reversal, constant-time common extensions, Lyndon roots.

A run is a stretch of words with smallest period q, at least min_length words and min_exponent periods long, that no
neighbouring word extends keeping the period. Within a text:

1. Ukkonen's algorithm builds the suffix trees of the word sequence and of its reversal, online and in linear time.
2. An Euler tour of a tree with blocked range minima over its string depths answers lowest common ancestors, hence longest
   common extensions (LCE), in constant time and linear space.
3. Every run has a root that is the longest Lyndon word at its place under one of two opposite orders of the words. The
   longest Lyndon word at i ends where the next smaller suffix begins; the suffixes' ranks come from the same tree.
4. Each candidate (place, period) is extended in both directions by one LCE each; what is long enough is a run.

Trees are built where a run can be and nowhere else, without loss: a run of period q repeats at least `window` words q
places on (16 for 24 words and 3 periods), so each of its words is in a window that occurs twice in the text, and no word
next to it that is outside such windows can extend it. Windows are compared by 64-bit hashes (a collision costs a tree);
words inside trees by themselves. A text is one row, handled whole in one task; memory is linear in it.

Defined cases: a null text has no words and an empty kept_text; an empty table gives no rows; rows with one id, or none,
stay separate rows; runs that share words are all returned; of further columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C

#: Positions of a tour that one block of the range minima covers.
BLOCK = 16


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """(parent, first place of its edge, end of its edge, suffix or -1) of each node; node 0 is the root. s ends with a symbol that stands nowhere else."""
    n, width = len(s), max(s) + 1
    parent, start, stop, suffix, link = [0], [0], [0], [-1], [0]
    child: dict[int, int] = {}
    node = at = size = waiting = leaves = 0
    for i, c in enumerate(s):
        waiting += 1
        fresh = 0  # the inner node that still needs its suffix link
        while waiting:
            if not size:
                at = i
            key = node * width + s[at]
            v = child.get(key)
            if v is None:
                child[key] = len(parent)
                parent.append(node)
                link[fresh] = node if fresh else 0
                fresh = 0
            else:
                begin = start[v]
                length = stop[v] - begin
                if size >= length:
                    node = v
                    size -= length
                    at += length
                    continue
                if s[begin + size] == c:
                    link[fresh] = node if fresh else 0
                    size += 1
                    break
                mid = len(parent)
                child[key] = mid
                child[mid * width + s[begin + size]] = v
                child[mid * width + c] = mid + 1
                parent.append(node)
                parent.append(mid)
                parent[v] = mid
                start.append(begin)
                stop.append(begin + size)
                start[v] = begin + size
                suffix.append(-1)
                link.append(0)
                link[fresh] = mid if fresh else 0
                fresh = mid
            start.append(i)
            stop.append(n)
            suffix.append(leaves)
            link.append(0)
            leaves += 1
            waiting -= 1
            if node:
                node = link[node]
            elif size:
                size -= 1
                at = i - waiting + 1
    return parent, start, stop, suffix


def tour(s: list[int], tree: tuple[list[int], ...], descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(string depths along the Euler tour, the place of each suffix in it). Siblings go by their first symbol, 0 first, the others the other way round if descending."""
    parent, start, stop, suffix = (np.array(x) for x in tree)
    first = np.array(s)[start]
    order = np.lexsort((np.where(first, -first, first.min() - first.max() - 1) if descending else first, parent))
    order = order[order != 0]
    bounds = np.searchsorted(parent[order], np.arange(len(parent) + 1)).tolist()
    kids, sizes, leaf = order.tolist(), (stop - start).tolist(), suffix.tolist()
    depth, depths, place = [0] * len(leaf), [], [0] * len(s)
    stack = [0]
    while stack:
        v = stack.pop()
        if v < 0:
            depths.append(depth[~v])
            continue
        if leaf[v] >= 0:
            place[leaf[v]] = len(depths)
            depths.append(depth[v])
            continue
        d = depth[v]
        depths.append(d)
        back = False
        for k in reversed(kids[bounds[v] : bounds[v + 1]]):
            depth[k] = d + sizes[k]
            if back:
                stack.append(~v)
            stack.append(k)
            back = True
    return np.array(depths, np.int32), np.array(place, np.int64)


class Minima:
    """Constant-time minima of ranges: prefix and suffix minima of blocks, and a sparse table over the blocks."""

    def __init__(self, values: np.ndarray):
        rows = np.full(-(-len(values) // BLOCK) * BLOCK, np.iinfo(values.dtype).max, values.dtype)
        rows[: len(values)] = values
        self.flat = rows
        rows = rows.reshape(-1, BLOCK)
        self.upto = np.minimum.accumulate(rows, axis=1).ravel()
        self.onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [rows.min(axis=1)]
        while 2 << len(self.levels) - 1 <= len(self.levels[0]):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The least value of each range, both ends included."""
        a, b = left // BLOCK, right // BLOCK
        out = np.minimum(self.onward[left], self.upto[right])
        between = b - a - 1
        for k in range(len(self.levels)):
            at = np.flatnonzero((between >= 1 << k) & (between < 2 << k))
            if len(at):
                out[at] = np.minimum(out[at], np.minimum(self.levels[k][a[at] + 1], self.levels[k][b[at] - (1 << k)]))
        at = np.flatnonzero(a == b)
        out[at] = self.flat[left[at]]
        for k in range(1, BLOCK):
            at = at[left[at] + k <= right[at]]
            out[at] = np.minimum(out[at], self.flat[left[at] + k])
        return out


class Extensions:
    """Longest common extensions of the suffixes of s, by lowest common ancestors."""

    def __init__(self, s: list[int]):
        self.tree = suffix_tree(s)
        depths, self.place = tour(s, self.tree)
        self.least = Minima(depths)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[i], self.place[j]
        return self.least(np.minimum(a, b), np.maximum(a, b))


def next_smaller(rank: list[int]) -> list[int]:
    """For each place but the last the next place with a smaller rank; the last has the smallest."""
    out, open_ = [0] * (len(rank) - 1), [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        r = rank[i]
        while rank[open_[-1]] > r:
            open_.pop()
        out[i] = open_[-1]
        open_.append(i)
    return out


def runs_of(s: list[int], min_length: int, min_exponent: int) -> np.ndarray:
    """(start, length, period) of the runs of the symbols, which are 1 or more, by start and period."""
    n = len(s)
    forward, backward = Extensions([*s, 0]), Extensions([*s[::-1], 0])
    i = np.arange(n)
    found = []
    for place in (forward.place, tour([*s, 0], forward.tree, descending=True)[1]):
        j = np.array(next_smaller(place.tolist()))
        start, end = i - backward(n - i, n - j), j + forward(i, j)
        good = end - start >= np.maximum(min_length, min_exponent * (j - i))
        found.append(np.stack([start[good], j[good] - i[good], (end - start)[good]], axis=1))
    return np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]]


def repeated_window(min_length: int, min_exponent: int) -> int:
    """The least number of words that a run repeats one period on."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def stretches(words: list[bytes], window: int) -> list[tuple[int, int]]:
    """(start, end) of the longest stretches of which every word is in a window that occurs elsewhere in words too."""
    n = len(words) - window + 1
    if n < 2:
        return []
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(C.mixed(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)) * C.powers(C.BASE, len(words)), out=total[1:])
    key = (total[window:] - total[:-window]) * C.powers(C.BASE_INV, n)
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(key, twice))
    cut = np.flatnonzero(at[1:] - at[:-1] > window)
    return list(zip(at[np.r_[0, cut + 1]].tolist(), (at[np.r_[cut, len(at) - 1]] + window).tolist(), strict=True))


def runs_of_words(words: list[bytes], min_length: int, min_exponent: int) -> np.ndarray:
    """(start, length, period) of the runs of a text's words, by start and period."""
    found = []
    for a, b in stretches(words, repeated_window(min_length, min_exponent)):
        if b - a >= min_length:
            ids: dict[bytes, int] = {}
            own = runs_of([ids.setdefault(w, len(ids) + 1) for w in words[a:b]], min_length, min_exponent)
            found.append(own + np.array([a, 0, 0]))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def find_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, n_words, runs (start, length, period of each, by start and period; words numbered from 0), and kept_text, the words that no run holds after its first period, joined by a space. min_exponent is 2 or more."""
    if min_exponent < 2:
        raise ValueError("a run has two periods or more")
    C.prepare_python(docs.sparkSession)
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, found, kept = [], [0], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = (text or b"").split()  # bytes split at 0x20 and 0x09-0x0D alone
                runs = runs_of_words(words, min_length, min_exponent)
                sizes.append(len(words))
                ends.append(ends[-1] + len(runs))
                if len(runs):
                    found.append(runs)
                    stays = np.ones(len(words), bool)
                    for start, length, period in runs.tolist():
                        stays[start + period : start + length] = False
                    words = compress(words, stays.tolist())
                kept.append(b" ".join(words))
            flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "kept_text"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text string")
