"""What the training-data operators share: tables, written cuts of the lineage, text as flat arrays."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graylane.storage import shared_dir, written

__all__ = ["shared_dir", "written"]

#: Bytes of text that the array helpers hold at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Rows and bytes of an Arrow batch sent to a Python worker, whichever is reached first.
BATCH_ROWS, BATCH_BYTES = "1000", "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare_python(spark: SparkSession) -> None:
    """Arrow batches of whole texts stay small, so that a worker's memory follows neither the row count nor the texts; workers find this package.

    The session keeps these settings, which change no result of any query.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, env.get("PYTHONPATH", "")) if x)


def crc_mod(doc_id: str, k: int):
    """crc32 of the id's decimal text, modulo k: the fold of a labelled row."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % k


def run_edges(t: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of rows with equal keys."""
    change = np.zeros(max(0, len(t) - 1), bool)
    for k in keys:
        values = t.column(k).to_numpy()
        change |= values[1:] != values[:-1]
    at = np.flatnonzero(change) + 1
    return np.r_[0, at], np.r_[at, len(t)]


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs from batches sorted by keys: a run that may go on in the next batch waits for it."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if len(t):
            cut = int(run_edges(t, keys)[0][-1])
            if cut:
                yield t.slice(0, cut)
            t = t.slice(cut)
        rest = t
    if rest is not None and len(rest):
        yield rest


# ---- text as flat arrays -------------------------------------------------------------------------------------------

_M = np.random.Generator(np.random.PCG64(20250101))
#: A random 64-bit value for each byte, and the base of the positional hash with its inverse modulo 2**64.
BYTE_VALUE = _M.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def class_table(delimiters: bytes | range | list[int]) -> np.ndarray:
    """True for each byte that is part of a word."""
    out = np.ones(256, bool)
    out[list(delimiters)] = False
    return out


#: `[^\x20\x09-\x0D]+`
NON_SPACE = class_table([0x20, *range(0x09, 0x0E)])
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower case
ALNUM = class_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: A-Z to a-z, all other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pieces(column: pa.Array | pa.ChunkedArray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets of the rows in them) of a string column, at most so many bytes or one row at a time; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and at[-1] else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_spans(text: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, number of words before each row) of the words; a row's end ends a word. text is in lower case already where that matters."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = is_word[text]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edge = at[(at > 0) & (at < n)]
    before[edge] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, at)


def span_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the span stands."""
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[text] * powers(BASE, len(text)), out=total[1:])
    return mixed((total[end] - total[start]) * powers(BASE_INV, len(text) + 1)[start] + (end - start).astype(np.uint64))
