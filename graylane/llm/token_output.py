"""Token-id output: shards of ids compressed by a Re-Pair grammar, with random access.

Texts are dealt out in ascending order of doc_id, tokenized in each task and gathered into shards of about SHARD_IDS ids
(whole documents). Within a shard the most frequent pairs of neighbouring symbols become new symbols, round after round
(a batch of pairs each round, never across the end of a document), until no pair is frequent enough to save more bytes
than its rule takes.
A shard is one row of the written table:

- part, shard: its place in the order of all ids; n_ids, n_docs, n_null (documents without an id, which come first)
- doc_ids (int64), lengths (uint32 ids of each document), symbols (uint32 symbols of each document)
- alphabet (uint32): the ids that occur in the shard, ascending; symbol k below base, their number, is the k-th of them
- rules (uint32 pairs; rule k is symbol base + k and refers to smaller symbols), spans (uint32 expansion lengths)
- body: the symbols of all documents, uint16 where they fit (width 2), else uint32 (width 4); all little-endian

A document's symbols, and with the expansion lengths any range of its ids, are found without decoding what stands before;
of the grammar only the rules are followed that the range needs.

Defined cases: a null or empty text has the end id alone; rows with one doc_id follow each other in the order of their
texts' hash; a null doc_id comes first; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graylane.llm import common as C

SHARD_IDS, PAIRS_A_ROUND = 1_000_000, 2048
#: A rule is stored as two symbols and a span of four bytes each.
RULE_BYTES, _ODD = 12, 0x9E3779B97F4A7C15


class Encoder:
    """The tokenizer, with the ids of words met before.

    The tokenizer's pattern begins a new piece at each single space between two other characters, and pieces are encoded
    one by one; so a text cut there has the ids of its parts. Texts with other white space next to a space, and
    tokenizers for which a probe shows another rule, are encoded whole. At most MEMO parts are kept.

    A new part of ASCII letters and a mark, and maybe a line break and the like behind it, gets the ids of its pieces, so
    that a word is encoded once whatever mark follows; not with tokenizers for which a probe of all marks shows another rule.
    """

    MEMO = 1_000_000
    PROBES = ("ab cd", "It's a   b, c\n d.", "é1 (x) y", "one two three")
    MARKS, PIECES = ".,;:!?", re.compile(r"([A-Za-z]+)([.,;:!?]?)(?:\n([A-Za-z]+)([.,;:!?]?))?")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.base = self.t.get_vocab_size(with_added_tokens=True)
        self.spaced = np.array([(self.t.id_to_token(i) or "").startswith(chr(0x120)) for i in range(self.base)])
        self.memo: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.mark = {m: self.whole([m])[0] if m else b"" for m in ("", "\n", *self.MARKS)}
        self.pieces, self.cuts = True, True
        self.pieces = all(self.encode([x])[0] == self.whole([x])[0] for m in ("", *self.MARKS) for x in (f"x ab{m} Cd{m}\nEf{m} gh", f"x ab{m}\ncd i"))
        self.memo.clear()
        self.cuts = all(self.encode([x])[0] == self.whole([x])[0] for x in self.PROBES)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, parts: set[str], memo: dict[str, bytes], lead: str) -> None:
        new = [p for p in parts.difference(memo) if p and not p[0].isspace() and not p[-1].isspace()]
        if not (lead and self.pieces):
            self.learn_whole(new, memo, lead)
            return
        composed = [(p, m.groups("")) for p in new if not p.isalpha() and (m := self.PIECES.fullmatch(p))]
        words = {g[0] for _, g in composed}.difference(memo)
        self.learn_whole(list(words.union(new).difference([p for p, _ in composed])), memo, lead)
        self.learn_lines(list({g[2] for _, g in composed if g[2]}.difference(self.heads)))
        for p, (word, mark, below, its) in composed:
            memo[p] = memo[word] + self.mark[mark] + (self.mark["\n"] + self.heads[below] + self.mark[its] if below else b"")

    def learn_lines(self, new: list[str]) -> None:
        """Words of letters at the beginning of a line: one text of all, a line each."""
        ids = np.frombuffer(self.whole(["\n".join(new)])[0], "<u4")
        at = np.flatnonzero(ids == np.frombuffer(self.mark["\n"], "<u4")[0])
        if len(self.mark["\n"]) == 4 and len(at) == len(new) - 1:
            raw, starts, ends = ids.tobytes(), [0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), 4 * len(ids)]
            self.heads.update(zip(new, map(raw.__getitem__, map(slice, starts, ends)), strict=True))
        else:
            self.learn_whole(new, self.heads, "")

    def learn_whole(self, new: list[str], memo: dict[str, bytes], lead: str) -> None:
        if not new:
            return
        if lead:  # one text of all parts: each begins with the only token that starts with its space
            ids = np.frombuffer(self.whole([lead + lead.join(new)])[0], "<u4")
            at = np.flatnonzero(self.spaced[ids])
            if len(at) == len(new):
                raw, ends = ids.tobytes(), [*(4 * at[1:]).tolist(), 4 * len(ids)]
                memo.update(zip(new, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
                return
        memo.update(zip(new, self.whole([lead + p for p in new]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.cuts:
            return self.whole(texts)
        for memo in (self.memo, self.heads):
            if len(memo) > self.MEMO:
                memo.clear()
        parts = [x.split(" ") for x in texts]
        self.learn({p[0] for p in parts if len(p[0]) < 200}, self.heads, "")
        found = [list(map(self.memo.get, p[1:])) for p in parts]
        lacking = [None in f for f in found]
        self.learn({x for p, f, lacks in zip(parts, found, lacking, strict=True) if lacks for x, ids in zip(p[1:], f, strict=True) if ids is None}, self.memo, " ")
        out: list[bytes | None] = []
        for p, f, lacks in zip(parts, found, lacking, strict=True):
            try:
                out.append(self.heads[p[0]] + b"".join(map(self.memo.__getitem__, p[1:]) if lacks else f))
            except KeyError:
                out.append(None)
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.whole([texts[i] for i in rest]), strict=True):
            out[i] = x
        return out


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def repair(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, mask of documents' ends, rules): ids with frequent pairs replaced; last marks the end of each document.

    A round counts all pairs and takes the PAIRS_A_ROUND most frequent ones that pay for their rule (RULE_BYTES), or a
    quarter of those that pay if these are more; of overlapping places the more frequent pair has its own. Rounds go on
    until no pair pays. A symbol takes two bytes up to 65,536 symbols and four beyond, where rounds go on by that cost;
    of the two grammars the one that takes fewer bytes is kept.
    """
    seq, last, rules = ids.astype(np.uint32), last.copy(), []
    narrow, width = None, 2 if base <= 65536 else 4
    while len(seq) > 1:
        # while two bytes hold a symbol, four hold a pair
        half, kind = (16, np.uint32) if base + len(rules) <= 65536 else (32, np.uint64)
        key = seq[:-1].astype(kind) << kind(half) | seq[1:]
        ok = ~last[:-1]
        # in a row of one symbol every other place counts
        same = np.flatnonzero((seq[:-1] == seq[1:]) & ok)
        first = np.r_[True, np.diff(same) != 1] if len(same) else np.zeros(0, bool)
        at = np.arange(len(same))
        ok[same[(at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 1]] = False
        places, least = key[ok], RULE_BYTES // width + 1
        places.sort()
        often = places[: max(0, len(places) - least + 1)]
        often = often[often == places[least - 1 :]]  # of n places of a pair the first n - least + 1
        edge = np.flatnonzero(np.r_[np.ones(min(1, len(often)), bool), often[1:] != often[:-1]])
        pairs, counts = often[edge], np.diff(edge, append=len(often)) + least - 1
        if not len(pairs):
            break
        most = min(len(pairs), max(PAIRS_A_ROUND, len(pairs) // 4))
        if width == 2:
            if base + len(rules) == 65536:
                narrow, width = (seq, last, len(rules)), 4
                continue
            most = min(most, 65536 - base - len(rules))
        top = np.sort(np.argpartition(counts, -most)[-most:])
        chosen, rank = pairs[top], np.empty(most, np.int64)
        rank[np.argsort(counts[top], kind="stable")] = np.arange(most)
        # a table of hashes leaves few places to look up
        odd, shift = kind(_ODD & (1 << 2 * half) - 1), kind(2 * half - 18)
        mark = np.zeros(1 << 18, bool)
        mark[chosen * odd >> shift] = True
        at = np.flatnonzero(mark[key * odd >> shift] & ok)
        slot = np.minimum(np.searchsorted(chosen, key[at]), most - 1)
        hit = chosen[slot] == key[at]
        at, slot = at[hit], slot[hit]
        # the most frequent pair has all its places, so every round replaces one at least
        near, mine = np.diff(at) == 1, rank[slot]
        own = np.ones(len(at), bool)
        own[1:] &= ~(near & (mine[:-1] > mine[1:]))
        own[:-1] &= ~(near & (mine[1:] > mine[:-1]))
        at, slot = at[own], slot[own]
        used = np.flatnonzero(np.bincount(slot, minlength=most) >= least)
        number = np.full(most, -1, np.int64)
        number[used] = base + len(rules) + np.arange(len(used))
        new = number[slot]
        at, new = at[new >= 0], new[new >= 0]
        picked = chosen[used].astype(np.int64)
        rules += zip((picked >> half).tolist(), (picked & ((1 << half) - 1)).tolist(), strict=True)
        seq, last = seq.copy(), last.copy()
        seq[at] = new
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
    if narrow is not None and 2 * len(narrow[0]) + RULE_BYTES * narrow[2] <= 4 * len(seq) + RULE_BYTES * len(rules):
        seq, last, rules = narrow[0], narrow[1], rules[: narrow[2]]
    return seq, last, np.array(rules, np.uint32).reshape(-1, 2)


def batches_of(rules: np.ndarray, base: int) -> Iterator[tuple[int, int]]:
    """(first, end) of stretches of rules that refer to none of their own stretch."""
    most, a = rules.max(axis=1).astype(np.int64) - base if len(rules) else np.zeros(0, np.int64), 0
    while a < len(rules):
        over = most[a:] >= a
        b = a + int(over.argmax()) if over.any() else len(rules)
        yield a, b
        a = b


def spans_of(rules: np.ndarray, base: int) -> np.ndarray:
    """The number of ids of each rule."""
    length = np.ones(base + len(rules), np.uint32)
    for a, b in batches_of(rules, base):
        length[base + a : base + b] = length[rules[a:b, 0]] + length[rules[a:b, 1]]
    return length[base:]


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces of flat, one behind the other."""
    ends = np.cumsum(length)
    return flat[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


def expand(symbols: np.ndarray, base: int, rules: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """The terminals of all the symbols."""
    length = np.r_[np.ones(base, np.int64), spans.astype(np.int64)]
    start = np.cumsum(length) - length
    flat = np.empty(int(length.sum()), np.uint32)
    flat[:base] = np.arange(base)
    for a, b in batches_of(rules, base):
        pair = rules[a:b].ravel()
        stop = start[base + b] if b < len(rules) else len(flat)
        flat[start[base + a] : stop] = _gathered(flat, start[pair], length[pair])
    return _gathered(flat, start[symbols], length[symbols])


def expand_range(symbols: np.ndarray, base: int, rules: np.ndarray, spans: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Terminals start .. stop of the symbols: level by level, only symbols that reach into the range are replaced."""
    while len(symbols):
        deep = symbols >= base
        length = np.ones(len(symbols), np.int64)
        length[deep] = spans[symbols[deep] - base]
        ends = np.cumsum(length)
        stop = min(stop, int(ends[-1]))
        i, j = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        before = int(ends[i - 1]) if i else 0
        symbols, deep, start, stop = symbols[i:j], deep[i:j], start - before, stop - before
        if not deep.any():
            return symbols[start:stop]
        first = np.where(deep, rules[np.where(deep, symbols - base, 0), 0], symbols)
        second = rules[symbols[deep] - base, 1]
        at = np.arange(len(symbols)) + np.cumsum(deep) - deep
        symbols = np.empty(len(symbols) + len(second), np.int64)
        symbols[at] = first
        symbols[at[deep] + 1] = second
    return symbols


def ids_of(shard: dict, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """ids start .. stop of the doc-th document of a shard (a row as a dict), decoding only the symbols that hold them."""
    base, rules, spans = shard["base"], np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), np.frombuffer(shard["spans"], "<u4")
    sizes = np.frombuffer(shard["symbols"], "<u4")
    first = int(sizes[:doc].sum(dtype=np.int64))
    body = np.frombuffer(shard["body"], f"<u{shard['width']}", int(sizes[doc]), first * shard["width"]).astype(np.int64)
    stop = int(np.frombuffer(shard["lengths"], "<u4", 1, 4 * doc)[0]) if stop is None else stop
    return np.frombuffer(shard["alphabet"], "<u4")[expand_range(body, base, rules, spans, start, stop)]


_SHARD = "part long, shard long, n_ids long, n_docs long, n_null long, doc_ids binary, lengths binary, symbols binary, base long, alphabet binary, rules binary, spans binary, width int, body binary"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written table of shards. tokenizer: the path of a file of the tokenizers library that all executors have."""
    C.prepare_python(docs.sparkSession)
    schema = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("doc_ids", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()), ("base", pa.int64()), ("alphabet", pa.binary()), ("rules", pa.binary()), ("spans", pa.binary()), ("width", pa.int32()), ("body", pa.binary())])

    def shard(k: int, doc_ids: list, ids: list[np.ndarray], most: int) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids)
        last = np.zeros(len(flat), bool)
        last[np.cumsum(lengths) - 1] = True
        present = np.zeros(most, bool)
        present[flat] = True
        alphabet, base = np.flatnonzero(present), int(present.sum())
        seq, ends, rules = repair((np.cumsum(present) - 1).astype(np.uint32)[flat], last, base)
        symbols = np.diff(np.r_[-1, np.flatnonzero(ends)])
        width = 2 if base + len(rules) <= 65536 else 4
        # null ids come first in the order, so their number tells them apart from every id
        nulls = sum(i is None for i in doc_ids)
        known = np.array([0 if i is None else i for i in doc_ids], "<i8")
        row = [TaskContext.get().partitionId(), k, len(flat), len(ids), nulls, known.tobytes(), lengths.astype("<u4").tobytes(), symbols.astype("<u4").tobytes(), base, alphabet.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), spans_of(rules, base).astype("<u4").tobytes(), width, seq.astype(f"<u{width}").tobytes()]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _encoder(tokenizer)
        base, end = max(t.base, end_id + 1), np.array([end_id], "<u4").tobytes()
        k, size, doc_ids, ids = 0, 0, [], []
        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for i in range(0, len(texts), 64):
                for name, raw in zip(names[i : i + 64], t.encode([x or "" for x in texts[i : i + 64]]), strict=True):
                    own = np.frombuffer(raw + end, "<u4")
                    doc_ids.append(name)
                    ids.append(own)
                    size += len(own)
                    if size >= SHARD_IDS:
                        yield shard(k, doc_ids, ids, base)
                        k, size, doc_ids, ids = k + 1, 0, [], []
        if ids:
            yield shard(k, doc_ids, ids, base)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("turn"))
    # rows of one id and text are alike, so any order of theirs will do, and a range may end between them
    rows = rows.repartitionByRange("doc_id", "h", "turn").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return C.written(rows.mapInArrow(run, _SHARD), "token-shards")


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the shards."""
    C.prepare_python(shards.sparkSession)
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # a row for each task that wrote, then the shards of each
    parts = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    first = (F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids") + F.col("before")).alias("first")
    starts = sizes.join(parts, "part").select("part", "shard", first)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids = expand(np.frombuffer(row["body"], f"<u{row['width']}"), row["base"], np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["spans"], "<u4"))
                ids = np.frombuffer(row["alphabet"], "<u4")[ids]
                n = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(n)
                names = np.frombuffer(row["doc_ids"], "<i8")
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                yield pa.record_batch([pa.array(names, mask=np.arange(len(names)) < row["n_null"]), pa.array(row["first"] + ends - n), pa.array(n), pa.array(crc, pa.int64())], schema=schema)

    return shards.join(starts, ["part", "shard"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
