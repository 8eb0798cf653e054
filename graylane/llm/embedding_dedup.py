"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised in double precision; equal ones form a class and are compared once. In each of TABLES tables a
vector's bucket is the tuple of floor((a . x + b) / WIDTH) over PROJECTIONS Gaussian directions a. For cosine 0.95, the
farthest that links, two vectors are 0.316 apart and meet in a bucket of one table with probability 0.116 (0.874 for each
direction), in one of the tables with 0.98; closer ones nearly always. Within a bucket all pairs are compared by exact
cosine in blocks; a pair that meets in several tables counts in the first of them, so only sums and a spanning forest of
the links leave a task, never the pairs. A bucket of more than PART classes is split into parts, and each pair of parts
is a task's work of its own.

Defined cases: a vector that is null, empty or zero, or has a null or non-finite component, links with nothing; vectors
of different lengths don't link; a null vec_id has no links and no component; rows with one vec_id count as separate
vectors; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C
from graylane.llm.graph import components

PROJECTIONS, TABLES, WIDTH, PART = 16, 32, 2.0, 1024


@functools.cache
def directions(dim: int, projections: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts; those of the first tables don't depend on how many tables there are."""
    a, b = np.random.Generator(np.random.PCG64(dim)), np.random.Generator(np.random.PCG64([dim, 1]))
    return a.standard_normal((projections * tables, dim)).T, b.uniform(0, WIDTH, projections * tables)


def bucket_keys(x: np.ndarray, projections: int, tables: int) -> np.ndarray:
    """One 64-bit key for each row of x and table."""
    a, b = directions(x.shape[1], projections, tables)
    cell = np.floor((x @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(x), tables, projections)
    key = np.full((len(x), tables), x.shape[1], np.uint64)
    for k in range(projections):
        key = C.mixed(key * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, k])
    return key.view(np.int64)


def normalised(column: pa.Array) -> list[bytes | None]:
    """Each vector divided by its length, as bytes of doubles; None where it links with nothing."""
    out: list[bytes | None] = [None] * len(column)
    lists = column.cast(pa.large_list(pa.float64()))
    flat = np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64)  # null components become nan
    at, there = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(there & (np.diff(at) > 0)):
        x = flat[at[i] : at[i + 1]]
        top = np.abs(x).max()
        if np.isfinite(top) and top > 0:
            x = x / top  # else very small or large components lose their squares
            out[i] = (x / np.sqrt(x @ x)).tobytes()
    return out


def _classes(vectors: DataFrame) -> DataFrame:
    schema = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = normalised(batch.column("embedding"))
            keys = [None if x is None else hashlib.blake2b(x, digest_size=16).digest() for x in xs]
            yield pa.record_batch([batch.column("vec_id").cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(xs, pa.binary())], schema=schema)

    return vectors.mapInArrow(run, "vec_id long, key binary, x binary")


def _buckets(classes: DataFrame, projections: int, tables: int) -> DataFrame:
    schema = pa.schema([("node", pa.int64()), ("tab", pa.int32()), ("bucket", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, xs = batch.column("node").to_numpy(), batch.column("x").to_pylist()
            lengths = np.array([len(x) for x in xs])
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                keys = bucket_keys(np.frombuffer(b"".join(xs[i] for i in rows)).reshape(len(rows), -1), projections, tables)
                yield pa.record_batch([pa.array(np.repeat(nodes[rows], tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))), pa.array(keys.ravel())], schema=schema)

    return classes.select("node", "x").mapInArrow(run, "node long, tab int, bucket long")


def _smallest_reached(m: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of m nodes the smallest that the edges a - b reach."""
    label = np.arange(m)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(rows: DataFrame, threshold: float, projections: int, tables: int) -> DataFrame:
    """(u, v, links): sums of links (v null) and forest edges (links 0) of each run of (tab, bucket, x_part, y_part)."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])

    def one(tab: int, node: np.ndarray, copies: np.ndarray, side: np.ndarray, same: bool, x: np.ndarray) -> pa.RecordBatch | None:
        found_a, found_b = [], []
        for i in range(0, len(x), 512):
            for j in range(i, len(x), 512):
                a, b = np.nonzero(x[i : i + 512] @ x[j : j + 512].T >= threshold)
                a, b = a + i, b + j
                keep = (a < b) if same else (a < b) & (side[a] != side[b])
                found_a.append(a[keep])
                found_b.append(b[keep])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if not len(a):
            return None
        label = _smallest_reached(len(x), a, b)
        child = np.flatnonzero(label != np.arange(len(x)))
        links = np.zeros(len(x), np.int64)
        keys = bucket_keys(x, projections, tab) if tab else None
        for k in range(0, len(a), 1 << 16):
            p, q = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            if keys is not None:  # pairs that met in an earlier table were counted there
                new = ~(keys[p] == keys[q]).any(1)
                p, q = p[new], q[new]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
        some = np.flatnonzero(links)
        u, v = np.r_[node[child], node[some]], np.r_[node[label[child]], node[some]]
        return pa.record_batch([pa.array(u), pa.array(v, mask=np.r_[np.zeros(len(child), bool), np.ones(len(some), bool)]), pa.array(np.r_[np.zeros(len(child), np.int64), links[some]])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.whole_runs(batches, ["tab", "bucket", "x_part", "y_part"]):
            col = {c: t.column(c).to_numpy() for c in ("tab", "node", "copies", "side", "x_part", "y_part")}
            xs = t.column("x").to_pylist()
            for s, e in zip(*C.run_edges(t, ["tab", "bucket", "x_part", "y_part"]), strict=True):
                if e - s > 1 and len({len(x) for x in xs[s:e]}) == 1:
                    x = np.frombuffer(b"".join(xs[s:e])).reshape(e - s, -1)
                    out = one(int(col["tab"][s]), col["node"][s:e], col["copies"][s:e], col["side"][s:e], col["x_part"][s] == col["y_part"][s], x)
                    if out is not None:
                        yield out

    return rows.mapInArrow(run, "u long, v long, links long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95, projections: int = PROJECTIONS, tables: int = TABLES) -> DataFrame:
    """For each row of vectors: vec_id, n_links, component_id (smallest vec_id reached), kept (its own component)."""
    spark = vectors.sparkSession
    C.prepare_python(spark)
    rows = C.written(_classes(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))), "vectors")
    # a class is a node of its own, whatever ids its rows have: one id may stand for several vectors
    classes = rows.filter("key is not null and vec_id is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("x").alias("x"))
    classes = C.written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    buckets = C.written(_buckets(classes, projections, tables), "vector-buckets")
    sizes = buckets.groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = buckets.join(sizes, ["tab", "bucket"]).withColumn("parts", F.expr(f"cast(n div {PART} + 1 as int)"))
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    members = members.select("tab", "bucket", "node", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    members = members.select("tab", "bucket", "node", F.least("part", "with").alias("x_part"), F.greatest("part", "with").alias("y_part"), (F.col("part") > F.col("with")).cast("int").alias("side"))
    members = members.join(classes.select("node", "copies", "x"), "node")
    members = members.repartition("tab", "bucket", "x_part", "y_part").sortWithinPartitions("tab", "bucket", "x_part", "y_part", "node")
    found = C.written(_compare(members, threshold, projections, tables), "vector-links")
    links = found.filter("v is null").groupBy("u").agg(F.sum("links").alias("others"))
    roots = components(found.filter("v is not null").select("u", "v"))
    of = classes.select("key", "node", "rep", "copies").join(links.withColumnRenamed("u", "node"), "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of = C.written(of.select("key", "root", "rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "vector-roots")
    of = of.join(of.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("key", "n_links", "component_id")
    known = F.col("vec_id").isNotNull()
    out = rows.select("vec_id", "key").join(of, "key", "left")
    component = F.when(known, F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
