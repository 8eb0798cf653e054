"""Quality rules: counts of a text, and lines that recur across the documents of a host.

1. One pass over the texts counts words, characters, symbols, repeated lines and repeated word triples, and names each line
   with a word by a 64-bit hash of its normal form (A-Z in lower case, digits as 0, words joined by one space).
2. Per host, distinct documents are counted for each line: equal texts count once, and so does a line within a text.
3. A line that more than least_docs documents and more than line_share percent of its host's distinct documents have is
   removed wherever it stands in that host.
4. A document is depleted if fewer than left_share percent of its words are left. It is kept if it passes the base rules
   (min_words words or more, at most repeat_share percent of them in repeated triples) and is not depleted.

Lines are counted where they were read before they are shuffled; of them only hashes move. The removed lines are broadcast
up to SEND_ROWS of them, and joined by a shuffle beyond that, where Spark splits a line that very many documents have.
A host and a line share one 64-bit key; two lines with one key would be counted together.

Defined cases: a null or empty text has no words and fails the base rules; rows without a host form one host; rows with
one id, or none, are judged each by its own text; equal rows get equal verdicts; an empty table gives no rows; columns that
are not named are ignored by judge and kept by clean. Texts are processed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graylane.llm import common as C
from graylane.llm.common import written

SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Most removed lines (8 bytes each) that are broadcast.
SEND_ROWS = 2_000_000
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_DECISION = ("doc_id", "h", "host", *_COUNTS, "base_failed", "n_removed_words", "removed", "depleted", "kept")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """How many words stand in a window of words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    key, many = codes[:n], len(ids)
    for k in range(1, window):
        # numbers of the windows so far stay below n, so the products fit
        key = np.unique(key * many + codes[k : n + k], return_inverse=True)[1]
    twice = np.bincount(key)[key] > 1
    inside = np.zeros(len(words), bool)
    for k in range(window):
        inside[k : n + k] |= twice
    return int(inside.sum())


def line_hash(line: bytes) -> tuple[int, int]:
    """(hash of the normal form, number of words) of a line."""
    words = line.translate(_NORMAL).split()  # bytes split at 0x20 and 0x09-0x0D alone
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True), len(words)


def counted(docs: DataFrame, host_col: str, id_col: str, text_col: str) -> DataFrame:
    """For each row: row, doc_id, h (hash of the text), host (hash), the counts, and of each line with a word its place, key (of host and line) and words."""
    C.prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(8)]
            for text in batch.column("text").to_pylist():
                text = text or ""
                raw = text.encode()
                words = raw.split()
                lines = [(i, x) for i, x in enumerate(raw.split(b"\n")) if x and not x.isspace()]
                hashes = [line_hash(x) for _, x in lines]
                values = (
                    len(words),
                    len(text) - sum(map(text.count, SPACE)),
                    sum(map(text.count, SYMBOLS)),
                    len(lines) - len({x for _, x in lines}),
                    repeated_words(words),
                    [i for i, _ in lines],
                    [h for h, _ in hashes],
                    [n for _, n in hashes],
                )
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            lists = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            found = [pa.array(x, pa.int64()) for x in rows[:5]] + [pa.array(x, t) for x, t in zip(rows[5:], lists, strict=True)]
            kept = ["row", "doc_id", "h", "host"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], [*kept, *_COUNTS, "places", "hashes", "line_words"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.xxhash64(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"row long, doc_id {kind}, h long, host long, {', '.join(f'{c} long' for c in _COUNTS)}, places array<int>, hashes array<long>, line_words array<int>")
    return written(out.withColumn("keys", F.expr("transform(hashes, x -> xxhash64(host, x))")).drop("hashes"), "rules-counts")


def frequent_lines(rows: DataFrame, line_share: int, least_docs: int) -> DataFrame:
    """key of the lines above the limits of their host."""
    texts = written(rows.select("host", "h", F.array_distinct("keys").alias("keys")).dropDuplicates(["host", "h"]), "rules-texts")
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    lines = texts.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least_docs)
    return written(lines.join(hosts, "host").filter(F.col("n") * 100 > F.col("docs") * line_share).select("key"), "rules-lines")


def judge(docs: DataFrame, host_col: str = "source", min_words: int = 50, repeat_share: int = 50, line_share: int = 10, least_docs: int = 5, left_share: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, h and host (hashes of its text and host), the counts, base_failed, n_removed_words, removed (places of its lines above the limits), depleted, kept."""
    rows = counted(docs, host_col, id_col, text_col)
    lines = frequent_lines(rows, line_share, least_docs)
    lines = F.broadcast(lines) if lines.count() <= SEND_ROWS else lines
    each = rows.select("row", F.explode(F.arrays_zip("keys", "places", "line_words")).alias("x")).select("row", "x.*").withColumnRenamed("keys", "key")
    gone = each.join(lines, "key").groupBy("row").agg(F.sum("line_words").alias("gone"), F.sort_array(F.collect_list("places")).alias("removed"))
    out = rows.drop("keys", "places", "line_words").join(gone, "row", "left")
    out = out.withColumn("n_removed_words", F.coalesce("gone", F.lit(0)).cast("long")).withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_share))
    out = out.withColumn("depleted", (F.col("n_words") - F.col("n_removed_words")) * 100 < F.col("n_words") * left_share)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")).select(*_DECISION)


def clean(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The kept rows of docs with all their columns, their texts without the lines above the limits."""
    kept = written(judge(docs, host_col, id_col=id_col, text_col=text_col, **limits).filter("kept").select("doc_id", "h", "host", "removed").dropDuplicates(["doc_id", "h", "host"]), "rules-kept")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.xxhash64(host_col).alias("host"))
    found = rows.join(kept, rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["h"] == kept["h"]) & (rows["host"] == kept["host"])).select("doc", "removed")
    left = F.array_join(F.filter(F.split(F.col("doc")[text_col], "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    return found.select(*[left.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])
