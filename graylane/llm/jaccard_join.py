"""N-gram Jaccard join over count vectors.

A document's set holds the 64-bit hashes of its distinct five-word shingles; a pair links when its Jaccard similarity is
0.8 or more. A shingle belongs to one of GROUPS groups, a document is the point of its counts in the groups, and the sum
of the smaller coordinates of two points (or of two boxes around points) is never less than the overlap of their sets.

1. One pass names the sets: class (documents with one set are one class), size, point, and the shingles that stand in
   several of a few thousand neighbouring documents, with counts.
2. The top of the tree, dealt out by Spark. Its coordinates are single shingles in one order, those found frequent last.
   Two linked sets of which the smaller asks for an overlap t share at least l of the first n - t + l coordinates of
   either set, whatever l is. Each class goes down to the cells of its first n - ceil(0.8 n) + l coordinates with
   l = n / 20 + 1, and only classes of which another class has enough too (the l of the smallest set that it could link
   with) go on. The pair meets in the
   first coordinate that both have, so the first n - ceil(0.8 n) + 1 cells of the classes that are left are enough.
3. Seeds: in each cell every class is paired with the cell's first one; at most two such pairs of each class are
   verified on the sets, if within the bound. They give first components, which keeps groups of many near copies from
   being compared all with all.
4. In the cells that hold more than one component (one cell of those with the same classes), an R-tree over the points
   (boxes of coordinate maxima, packed by size and two sums of coordinates) is joined with itself: pairs of boxes, then
   of points, whose bound is too small are left; surviving pairs of different components are verified. For BEST_ROUNDS
   rounds each class goes to its largest such cell and part alone and is verified against the partner with the highest
   bound, so that most components of a large group have met before the last round, in which every surviving pair of
   different components is verified. A cell of more than PART classes is split, each pair of its parts being work of its
   own.

Which shingles count as frequent changes only the work, never the result; at most FREQUENT_MOST of them are kept.

Defined cases: without words or text a set is empty and linked with nothing; fewer than five words are one shingle; rows
with one doc_id stay separate rows; a row with a null doc_id has a size and no component; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graylane.llm import common as C
from graylane.llm.graph import components

#: Words of a shingle; links from NEED[0] / NEED[1] of the summed sizes (J >= 0.8: overlap >= 4/9 of |A| + |B|).
WORDS, NEED = 5, (4, 9)
#: Groups of a point, a byte each; FULL stands for that many shingles or more.
GROUPS, FULL = 256, 255
#: Seen: in at least BLOCK_COUNT documents of a block of about BLOCK_SHINGLES shingles, so a shingle of d documents shows
#: once d is a few times the root of the number of blocks. Frequent: seen in FREQUENT_LEAST at least, in all blocks.
BLOCK_COUNT, BLOCK_SHINGLES, FREQUENT_LEAST, FREQUENT_MOST = 2, 6_000_000, 4, 500_000
#: Rounds in which a class is verified against its best partner in one cell alone, before all pairs of components that are still apart.
BEST_ROUNDS = 2
#: Names of classes that a task remembers, so as not to send copies twice.
KNOWN = 1_000_000
#: Classes of one part of a cell.
PART = 512
#: Up to this many ids (16 MB) go to all executors to pick texts; beyond, texts and ids are joined by a shuffle.
SEND_IDS = 2_000_000
_STEP, _ALL = np.uint64(0x9E3779B97F4A7C15), 2**64 - 1


def shingle_sets(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) for pieces of a text column."""
    for i, j, text, at in C.pieces(column):
        low = C.LOWER[text]
        start, end, before = C.word_spans(low, at, C.NON_SPACE)
        h = C.span_hashes(low, start, end)
        full = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            full = full * _STEP + h[k : len(h) - WORDS + 1 + k]
        full = C.mixed(full)
        sets = []
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if b - a >= WORDS:
                sets.append(np.unique(full[a : b - WORDS + 1]))
            elif b > a:
                whole = b - a
                for x in h[a:b].tolist():
                    whole = ((whole ^ (whole >> 29)) * int(_STEP) + x) & _ALL
                sets.append(C.mixed(np.array([whole], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield i, sets


def class_of(s: np.ndarray) -> int | None:
    """A 64-bit name of a set: the size and a sum of scrambled members."""
    if not len(s):
        return None
    total = (int(C.mixed(s ^ _STEP).sum(dtype=np.uint64)) + len(s) * int(_STEP)) & _ALL
    return int(C.mixed(np.array([total], np.uint64)).view(np.int64)[0])


def point_of(s: np.ndarray) -> bytes:
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=GROUPS), FULL).astype(np.uint8).tobytes()


def first_coordinates(n: int) -> tuple[int, int, int]:
    """(coordinates that a set of n goes down to, coordinates that it must share, coordinates of which two linked sets share one).

    A linked set has at least 0.8 n members, so its l is at least the second number, and both go down to so many in common.
    """
    common = -(-4 * n // 5)
    return n - common + n // 20 + 1, common // 20 + 1, n - common + 1


def _counts(held: list[np.ndarray]) -> pa.RecordBatch | None:
    """The shingles of held that stand in BLOCK_COUNT sets or more; held is emptied and its shingles sorted in place, so that a worker holds the block once."""
    values = np.concatenate(held)
    held.clear()
    values.sort()
    same = np.zeros(len(values) + 1, bool)  # as the one before
    np.equal(values[1:], values[:-1], out=same[1:-1])
    edges = np.flatnonzero(same[1:] != same[:-1])  # a run's first place, its last place
    first, n = edges[::2], edges[1::2] - edges[::2] + 1
    keep = n >= BLOCK_COUNT
    if not keep.any():
        return None
    k = int(keep.sum())
    return pa.record_batch([*[pa.nulls(k, pa.int64())] * 4, pa.nulls(k, pa.binary()), pa.array(values[first[keep]].view(np.int64)), pa.array(n[keep].astype(np.int64))], schema=_SIGNED)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("rk", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("point", pa.binary()), ("shingle", pa.int64()), ("seen", pa.int64())])


def signed(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, rk, n, cls, point) and rows of shingles (shingle, seen), in one pass over (doc_id, rk, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, known = 0, set()
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text")):
                names = [class_of(s) for s in sets]
                k = len(sets)
                yield pa.record_batch(
                    [*[batch.column(c).slice(first, k) for c in ("doc_id", "rk")], pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array([point_of(s) for s in sets], pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())],
                    schema=_SIGNED,
                )
                for name, s in zip(names, sets, strict=True):
                    if name is not None and name not in known:  # copies count once
                        known.add(name)
                        held.append(s)
                        size += len(s)
                if size >= BLOCK_SHINGLES:
                    if (out := _counts(held)) is not None:
                        yield out
                    held, size, known = [], 0, set()
        if held and (out := _counts(held)) is not None:
            yield out

    return docs.select("doc_id", "rk", "text").mapInArrow(run, "doc_id long, rk long, n long, cls long, point binary, shingle long, seen long")


def most_frequent(often: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles in ascending order, their counts) of the FREQUENT_MOST most frequent rows of the written often (shingle, seen).

    How many shingles have each count tells the least count that fits; only the rows from there on go to the driver, as
    Arrow batches, of those with the least count as many as there is room for by a hash.
    """
    sizes = often.groupBy("seen").agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts, n = (sizes.column(c).to_numpy().astype(np.int64) for c in ("seen", "n"))
    order = np.argsort(-counts)
    counts, upto = counts[order], np.cumsum(n[order])
    whole = int(np.searchsorted(upto, FREQUENT_MOST, "right"))
    if whole < len(counts):
        ties, room = int(np.diff(upto, prepend=0)[whole]), FREQUENT_MOST - int(upto[whole - 1] if whole else 0)
        edge = int(counts[whole])
        often = often.filter((F.col("seen") > edge) | ((F.col("seen") == edge) & (F.pmod(F.xxhash64("shingle"), F.lit(ties)) < room)))
    found = often.toArrow()
    shingles, seen = found.column("shingle").to_numpy().view(np.uint64), found.column("seen").to_numpy()
    kept = np.lexsort((shingles, -seen))[:FREQUENT_MOST]
    kept = kept[np.argsort(shingles[kept])]
    return shingles[kept], seen[kept]


def cells(docs: DataFrame, frequent: np.ndarray, seen: np.ndarray) -> DataFrame:
    """(cell, part, cls, asked, near): the first coordinates of each set; frequent (sorted) come last, the most frequent at the very end.

    part splits the cells of frequent shingles; asked is the number of coordinates that must be shared; near marks those
    of which two linked sets share one.
    """
    schema = pa.schema([("cell", pa.int64()), ("part", pa.int32()), ("cls", pa.int64()), ("asked", pa.int32()), ("near", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for _, sets in shingle_sets(batch.column("text")):
                out_cell, out_part, out_cls, lengths, asked, near = [], [], [], [], [], []
                for s in sets:
                    n, name = len(s), class_of(s)
                    if not n or name in known:
                        continue
                    if len(known) > KNOWN:  # a class that comes again is counted once later on
                        known.clear()
                    known.add(name)
                    first, shared, one = first_coordinates(n)
                    at = np.searchsorted(frequent, s)
                    often = at < len(frequent)
                    often[often] = frequent[at[often]] == s[often]
                    rare = s[~often][:first]
                    part = np.full(first, -1, np.int32)
                    if len(rare) < first:
                        more = at[often]
                        more = more[np.lexsort((more, seen[more]))][: first - len(rare)]
                        parts = seen[more] // PART + 1
                        part[len(rare) :] = np.where(parts > 1, np.uint64(name & _ALL) % parts.astype(np.uint64), -1)
                        rare = np.concatenate([rare, frequent[more]])
                    out_cell.append(rare)
                    out_part.append(part)
                    out_cls.append(name)
                    lengths.append(first)
                    asked.append(shared)
                    near.append(np.arange(first) < one)
                if out_cell:
                    columns = [np.concatenate(out_cell).view(np.int64), np.concatenate(out_part), np.repeat(np.array(out_cls, np.int64), lengths), np.repeat(np.array(asked, np.int32), lengths), np.concatenate(near)]
                    yield pa.record_batch([pa.array(c) for c in columns], schema=schema)

    return docs.select("text").mapInArrow(run, "cell long, part int, cls long, asked int, near boolean")


# ---- the R-tree of one cell --------------------------------------------------------------------------------------


def bound_ok(low: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return NEED[1] * low >= NEED[0] * (n_a + n_b)


def point_bound(p: np.ndarray, q: np.ndarray, n_p: np.ndarray, n_q: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of the rows of p and q; without a bound where a count did not fit."""
    low = np.minimum(p, q)
    over = (low == FULL).any(-1)
    return np.where(over, np.minimum(n_p, n_q), np.minimum(low.sum(-1, dtype=np.int64), np.minimum(n_p, n_q)))


def packed(n: np.ndarray, points: np.ndarray, leaf: int) -> np.ndarray:
    """The order in which points are packed into leaves: slabs by size, in these by one sum of coordinates, then by another, so that near copies stand together."""
    m = len(n)
    slabs = max(1, round((m / leaf) ** (1 / 3)))
    order = np.argsort(n, kind="stable")
    for k, half in ((slabs, points[:, : GROUPS // 2]), (slabs * slabs, points[:, ::2])):
        slab = np.empty(m, np.int64)
        slab[order] = np.arange(m) * k // m
        order = np.lexsort((half.sum(1, dtype=np.int64), slab))
    return order


def tree_pairs(n: np.ndarray, points: np.ndarray, leaf: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs whose points' bound allows a link, a bounded number at once: an R-tree joined with itself.

    The boxes of a level are those of neighbouring boxes below it. From the root down, a pair of boxes stays if the summed
    minima of its upper corners reach the overlap that its least sizes need.
    """
    m = len(n)
    order = packed(n, points, leaf)
    levels = []  # of (upper corner, least size, largest size), leaves first
    high, least, most = points[order], n[order], n[order]
    while len(least) > 1:
        edges = np.arange(0, len(least), leaf)
        high, least, most = np.maximum.reduceat(high, edges), np.minimum.reduceat(least, edges), np.maximum.reduceat(most, edges)
        levels.append((high, least, most))
    i, j = np.divmod(np.arange(leaf * leaf), leaf)
    if not levels:
        return
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        high, least, most = levels[level]
        low = point_bound(high[a], high[b], most[a], most[b])
        keep = bound_ok(low, least[a], least[b])
        a, b = a[keep], b[keep]
        for s in range(0, len(a), 64):
            x, y = (a[s : s + 64, None] * leaf + i).ravel(), (b[s : s + 64, None] * leaf + j).ravel()
            if level:  # each pair of boxes becomes the pairs of their children
                there = (x <= y) & (y < len(levels[level - 1][1]))
                stack.append((level - 1, x[there], y[there]))
                continue
            there = (x < y) & (y < m)
            x, y = order[x[there]], order[y[there]]
            keep = bound_ok(point_bound(points[x], points[y], n[x], n[y]), n[x], n[y])
            yield x[keep], y[keep]


def _cell_pairs(rows: DataFrame, best: bool) -> DataFrame:
    """(u, v) of different components within each (cell, x, y) of rows sorted by it, of more than 8 classes each one's best partner or all; side is 0 or 1 where x and y are different parts."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: t.column(c).to_numpy() for c in ("cell", "x", "y", "cls", "root", "side", "n")}
        points = np.frombuffer(b"".join(t.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)

        def batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            keep = (col["root"][a] != col["root"][b]) & ((col["x"][a] == col["y"][a]) | (col["side"][a] != col["side"][b]))
            u, v = col["cls"][a[keep]], col["cls"][b[keep]]
            u, v = np.minimum(u, v), np.maximum(u, v)
            return pa.record_batch([pa.array(u), pa.array(v)], schema=schema)

        starts, ends = C.run_edges(t, ["cell", "x", "y"])
        size = ends - starts
        for m in range(2, 9):  # small cells of one size at once
            at = starts[size == m]
            i, j = np.triu_indices(m, 1)
            for k in range(0, len(at), 2048):
                x, y = (at[k : k + 2048, None] + i).ravel(), (at[k : k + 2048, None] + j).ravel()
                keep = bound_ok(point_bound(points[x], points[y], col["n"][x], col["n"][y]), col["n"][x], col["n"][y])
                yield batch(x[keep], y[keep])
        for k in np.flatnonzero(size > 8):
            n, p, root = (x[starts[k] : ends[k]] for x in (col["n"], points, col["root"]))
            most = np.zeros(size[k], np.int64)  # the highest bound over the sizes, and with whom
            for x, y in tree_pairs(n, p):
                if not best:
                    yield batch(x + starts[k], y + starts[k])
                    continue
                apart = root[x] != root[y]
                x, y = x[apart], y[apart]
                bound = (point_bound(p[x], p[y], n[x], n[y]) << 20) // (n[x] + n[y]) << 20
                np.maximum.at(most, x, bound | y)
                np.maximum.at(most, y, bound | x)
            if best:
                x = np.flatnonzero(most)
                yield batch(x + starts[k], (most[x] & ((1 << 20) - 1)) + starts[k])

    def once(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).group_by(["u", "v"]).aggregate([]).combine_chunks()
        return pa.record_batch([t.column(c).combine_chunks() for c in ("u", "v")], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in C.whole_runs(batches, ["cell", "x", "y"]):
            for out in found(t):
                if out.num_rows:
                    held.append(out)
                    size += out.num_rows
                if size > 500_000:  # a pair meets in many cells
                    yield once(held)
                    held, size = [], 0
        if held:
            yield once(held)

    return rows.mapInArrow(run, "u long, v long")


# ---- verification ------------------------------------------------------------------------------------------------


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the distinct pairs (u, v) of classes whose sets reach the similarity; sets are built for these classes alone."""
    spark = pairs.sparkSession
    names = pairs.select(F.col("u").alias("cls")).unionByName(pairs.select(F.col("v").alias("cls"))).distinct()
    ids = C.written(classes.join(names, "cls").select("cls", "rep"), "jaccard-picked")
    sent = F.broadcast if ids.count() <= SEND_IDS else lambda df: df
    texts = docs.join(sent(ids.select(F.col("rep").alias("rk")).distinct()), "rk", "left_semi").select("text")
    schema = pa.schema([("cls", pa.int64()), ("members", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int | None] = {None}
        for batch in batches:
            for _, sets in shingle_sets(batch.column("text")):
                if len(known) > KNOWN:  # a class that comes again is verified once more
                    known = {None}
                sets = [s for s in sets if (name := class_of(s)) not in known and not known.add(name)]
                yield pa.record_batch([pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a"), batch.column("b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= 80 * (len(p) + len(q) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    # only classes in question come along; equal hashes of other rows may bring other texts, which the join by class leaves out
    sets = C.written(texts.mapInArrow(build, "cls long, members binary").join(sent(ids.select("cls")), "cls", "left_semi"), "jaccard-sets")
    both = pairs.join(sets.select(F.col("cls").alias("u"), F.col("members").alias("a")), "u").join(sets.select(F.col("cls").alias("v"), F.col("members").alias("b")), "v")
    return both.select("u", "v", "a", "b").mapInArrow(compare, "u long, v long")


def _open_cells(placed: DataFrame) -> DataFrame:
    """(cell, m, parts) of the cells with several components, one of those that hold the same classes.

    Cells with the same members give the same pairs; members are compared by their number and three sums of hashes.
    """
    sums = [F.sum(F.shiftrightunsigned(F.xxhash64("cls", F.lit(k)), 32)).alias(f"s{k}") for k in range(3)]
    cells_ = placed.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m"), *sums).filter("lo != hi")
    return cells_.groupBy("m", "s0", "s1", "s2").agg(F.min("cell").alias("cell")).select("cell", "m", F.expr(f"cast(m div {PART} + 1 as int)").alias("parts"))


def _seeds(pairs: DataFrame, sized: DataFrame) -> DataFrame:
    """Of the pairs (u, v), repeated once for each cell, at most two for each v within the bound: with the smallest u and with the most cells."""
    counted = pairs.filter("u != v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("k"))
    picked = counted.groupBy("v").agg(F.min("u").alias("a"), F.max_by("u", F.struct("k", "u")).alias("b"))
    picked = picked.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("u"), "v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    near = picked.join(sized.select(F.col("cls").alias("u"), F.col("n").alias("n_u"), F.col("point").alias("p_u")), "u").join(sized.select(F.col("cls").alias("v"), F.col("n").alias("n_v"), F.col("point").alias("p_v")), "v")

    def within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS) for c in ("p_u", "p_v"))
            n_u, n_v = (batch.column(c).to_numpy() for c in ("n_u", "n_v"))
            yield batch.select(["u", "v"]).filter(pa.array(bound_ok(point_bound(p, q, n_u, n_v), n_u, n_v)))

    ratio = (F.col("n_u") * 5 >= F.col("n_v") * 4) & (F.col("n_v") * 5 >= F.col("n_u") * 4)
    return C.written(near.filter(ratio).select("u", "v", "n_u", "n_v", "p_u", "p_v").mapInArrow(within_bound, "u long, v long"), "jaccard-seeds")


def join_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_ids: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: doc_id, rk, n, cls; classes: cls, rep, least_id, n; roots: node, root of the classes that link with others).

    rk is the hash of id and text; with null_ids rows without an id have a class as well.
    """
    spark = docs.sparkSession
    C.prepare_python(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("rk"), F.col(text_col).alias("text"))
    marks = C.written(signed(docs), "jaccard-signed")
    rows = marks.filter("n is not null").select("doc_id", "rk", "n", "cls", "point")
    frequent, seen = most_frequent(C.written(marks.filter("seen is not null").groupBy("shingle").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= FREQUENT_LEAST), "jaccard-often"))
    named = rows.filter("cls is not null" if null_ids else "cls is not null and doc_id is not null")
    classes = C.written(named.groupBy("cls").agg(F.min("rk").alias("rep"), F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("point").alias("point")), "jaccard-classes")

    # a cell that one class has, or one part of a frequent cell, may be met by no other
    within = Window.partitionBy("cell", "part")
    groups = cells(docs if null_ids else docs.filter("doc_id is not null"), frequent, seen)
    groups = groups.withColumn("pivot", F.min("cls").over(within)).withColumn("last", F.max("cls").over(within))
    groups = C.written(groups.filter("part >= 0 or pivot != last").drop("last"), "jaccard-shared")
    kept = groups.groupBy("cls").agg(F.count_distinct("cell").alias("shared"), F.first("asked").alias("asked")).filter("shared >= asked").select("cls")
    groups = C.written(groups.filter("near").join(kept, "cls").select("cell", "part", "cls", "pivot").distinct(), "jaccard-cells")

    split = groups.filter("part >= 0").select("cell", "pivot").distinct()
    heads = split.join(split.groupBy("cell").agg(F.min("pivot").alias("head")), "cell").select(F.col("head").alias("u"), F.col("pivot").alias("v"))
    sized = classes.select("cls", "n", "point")
    seeds = _seeds(groups.select(F.col("pivot").alias("u"), F.col("cls").alias("v")).unionByName(heads), sized)
    roots = components(verified(seeds, classes, docs))

    for k in range(BEST_ROUNDS + 1):
        best = k < BEST_ROUNDS
        placed = groups.select("cell", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        placed = C.written(placed, "jaccard-placed")
        open_rows = placed.join(_open_cells(placed), "cell")
        if best:
            largest = open_rows.groupBy("cls").agg(F.max(F.struct("m", "cell"))["cell"].alias("cell"))
            open_rows = open_rows.join(largest, ["cls", "cell"])
        # parts are dealt anew in each round, so that those of one cell meet in the best rounds as well
        open_rows = open_rows.withColumn("part", F.pmod(F.xxhash64("cls", F.lit(k)), F.col("parts")).cast("int"))
        others = F.array("part") if best else F.sequence(F.lit(0), F.col("parts") - 1)
        open_rows = open_rows.join(sized, "cls").select("cell", "part", F.explode(others).alias("with"), "cls", "root", "n", "point")
        open_rows = open_rows.select("cell", F.least("part", "with").alias("x"), F.greatest("part", "with").alias("y"), "cls", "root", F.when(F.col("part") > F.col("with"), 1).otherwise(0).alias("side"), "n", "point")
        open_rows = open_rows.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y")
        pairs = C.written(_cell_pairs(open_rows, best).distinct(), "jaccard-pairs")
        if not pairs.isEmpty():
            # each class and its root stand for the links found before
            links = C.written(verified(pairs, classes, docs), "jaccard-links")
            if not links.isEmpty():
                roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links))
    return rows.select("doc_id", "rk", "n", "cls"), classes.select("cls", "rep", "least_id", "n"), roots


def class_roots(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """(cls, least_id, root): the component of each class."""
    of = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    return C.written(of.select("cls", "least_id", "root"), "jaccard-roots")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    rows, classes, roots = join_classes(docs, id_col, text_col)
    of = class_roots(classes, roots)
    of = of.join(of.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("cls", "component_id")
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(of, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), known.alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rk, kept, rows) for each distinct (id, text) with words: kept marks the one of each component that has the smallest id (null last); rows counts the rows that are alike.

    rk = xxhash64(cast(id as long), text). Rows without an id count as documents here.
    """
    rows, classes, roots = join_classes(docs, id_col, text_col, null_ids=True)
    of = class_roots(classes, roots).select("cls", "root")
    alike = rows.filter("cls is not null").groupBy("cls", "doc_id", "rk").agg(F.count(F.lit(1)).alias("rows")).join(of, "cls")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk"))["rk"]
    best = alike.groupBy("root").agg(first.alias("best"))
    return alike.join(best, "root").select("rk", (F.col("rk") == F.col("best")).alias("kept"), "rows")
