"""Mixing sources to target weights by entropy balancing (DataFrame operations only).

The rates r of the documents of one source solve: least sum of r * (log r - 1) under sum of size * r = target and
r <= max_copies. Its solution is an exponential tilt, r = min(max_copies, exp(lam * size / mean size)), and the convex
dual has one unknown, lam, for each source. Equal sizes of a source have equal rates, so Newton's steps run on the
histogram (source, size, documents): each step is one distributed sum, and only one row for each source moves on.

Rounding: from the largest size down, each size takes the whole number of copies that brings the running total of words
nearest to the running total asked for, so what is left over is at most half of a small document; CELLS sizes of a source
are one such run, so a source of very many sizes has several. Within a size, copies are dealt evenly, the remainder in the
order of a hash of id and text, so reruns agree. Rows with one id and text are alike and are counted, not ranked.

Defined cases: null, empty and blank texts have size 0 and rate 1 with no words; a null source is a source of its own,
after all others; rows with one doc_id stay separate rows; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graylane.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source and size are ranked in groups of about this share of one bucket.
BUCKET_ROWS = 1024
#: Sizes of one source that are rounded one after the other.
CELLS = 256


def in_order(rows: DataFrame, order: list) -> DataFrame:
    """rows with place, their number (from 0) in a total order: sorted by ranges, numbered in each, plus the rows of the ranges before."""
    rows = written(rows.orderBy(*order).withColumn("mark", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("mark", 33)
    parts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # a row for each range, of which there are as many as shuffle partitions
    before = parts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    place = F.col("before") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("part", part).join(F.broadcast(before), "part").withColumn("place", place).drop("part", "before", "mark")


def source_targets(sources: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """(skey, source, source_size) to these and target, weight: all words shared by weight, at most max_copies times a source's own.

    Sources whose share is above their cap get the cap, and what they leave is shared again among the others until none is
    above: each round is one distributed sum, and only sums come back. Shares only grow from round to round, so a capped
    source stays capped and rounds end.
    """
    kinds = F.array(*[F.lit(w) for w in weights])
    s = in_order(sources, [F.col("source").asc_nulls_last()])
    s = s.withColumn("weight", F.element_at(kinds, (F.col("place") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * max_copies).drop("place")
    s = written(s, "mix-sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        over = F.col("cap") < F.lit(level) * F.col("weight")
        capped, free, n = s.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count_if(over)).first()
        # no one is left only if all caps are zero
        next_level = (total - capped) / free if free else level
        if next_level <= level:
            break
        level = next_level
    return s.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))).drop("cap")


def tilts(hist: DataFrame, targets: DataFrame, max_copies: int, steps: int, tolerance: float) -> DataFrame:
    """(skey, lam): Newton's method on the dual, kept within a bracket; a step is one sum over the histogram."""
    top = math.log(max_copies)
    state = targets.join(hist.groupBy("skey").agg((F.sum(F.col("size") * F.col("n")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean")), "skey")
    state = state.filter((F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * max_copies) & (F.col("target") > 0))
    state = written(state.select("skey", "target", "mean", F.lit(0.0).alias("lam"), (F.col("mean") * -700.0).alias("lo"), (F.col("mean") * top).alias("hi"), F.lit(1.0).alias("off")), "mix-state")
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        log_rate = F.least(F.lit(top), F.col("lam") * x)
        words = F.col("size") * F.col("n") * F.exp(log_rate)
        sums = (
            hist.filter("size > 0")
            .join(state, "skey")
            .groupBy("skey")
            .agg(*[F.first(c).alias(c) for c in ("target", "mean", "lam", "lo", "hi")], F.sum(words).alias("f"), F.sum(F.when(F.col("lam") * x < top, words * x).otherwise(0.0)).alias("g"))
        )
        off = F.log(F.col("target") / F.greatest(F.col("f"), F.lit(1e-300)))
        sums = sums.withColumn("off", off).withColumn("lo", F.when(off > 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(off < 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") + F.when(F.col("g") > 0, F.col("off") * F.col("f") / F.col("g"))
        middle = (F.col("lo") + F.col("hi")) / 2
        done = F.abs(F.col("off")) < tolerance
        state = written(
            sums.select("skey", "target", "mean", F.when(done, F.col("lam")).when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise(middle).alias("lam"), "lo", "hi", F.abs("off").alias("off")),
            "mix-state",
        )
        if not state.filter(F.col("off") >= tolerance).limit(1).count():
            break
    return state.select("skey", "mean", "lam")


def mix_alike(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, steps: int = 60, tolerance: float = 1e-9, row_key=None) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, h, copies and rows: how many of the rows with this id and h are taken so often.

    h is the hash of id and text, or row_key (a 64-bit column) where a caller tells rows apart by more. A group of rows can
    come in several rows of the result.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("skey"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        (F.xxhash64(F.col(id_col), F.col(text_col)) if row_key is None else row_key).alias("h"),
        F.spark_partition_id().alias("origin"),
    )
    sized = written(sized, "mix-sizes")
    hist = written(sized.groupBy("skey", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    sources = hist.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    targets = written(source_targets(sources, weights, max_copies), "mix-targets")
    total = hist.agg(F.sum("n")).first()[0] or 0

    x = F.least(F.lit(math.log(max_copies)), F.col("lam") * F.col("size") / F.col("mean"))
    full = F.when(F.col("target") >= F.col("source_size") * max_copies, float(max_copies)).when(F.col("target") <= 0, 0.0)
    rates = (
        hist.drop("source")
        .join(targets, "skey")
        .join(tilts(hist, targets, max_copies, steps, tolerance), "skey", "left")
        .withColumn("rate", F.when(F.col("size") == 0, 1.0).otherwise(F.coalesce(full, F.exp(x), F.lit(1.0))))
    )
    # error diffusion needs its cells in order; CELLS neighbouring sizes of a source are one array
    by_size = Window.partitionBy("skey").orderBy(F.desc("size"))
    rates = rates.withColumn("chunk", F.floor((F.row_number().over(by_size) - 1) / CELLS))
    cells = rates.groupBy("skey", "chunk", "source", "source_size", "target").agg(F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("cells"))
    whole = "greatest(0L, least({most} * c.n, if(c.size = 0, c.n, cast(round((a.want + c.size * c.n * c.rate - a.got) / c.size) as bigint))))".format(most=max_copies)
    copied = F.expr(f"""
        aggregate(cells, struct(0D as want, 0D as got, cast(array() as array<bigint>) as m),
            (a, c) -> named_struct('want', a.want + c.size * c.n * c.rate, 'got', a.got + c.size * {whole}, 'm', concat(a.m, array({whole})))).m""")
    cells = cells.select("skey", "source", "source_size", "target", F.explode(F.arrays_zip("cells", copied.alias("m"))).alias("z"))
    cells = cells.select("skey", "source", "source_size", "target", F.col("z.cells.size").alias("size"), F.col("z.cells.n").alias("n"), F.col("z.cells.rate").alias("rate"), F.col("z.m").alias("m"))

    # rows of one id and text are counted where they were read, so that no task gets them all
    alike = sized.groupBy("skey", "size", "doc_id", "h", "origin").agg(F.count(F.lit(1)).alias("alike"))
    alike = written(alike.withColumn("b", F.pmod(F.col("h"), F.lit(total // BUCKET_ROWS + 1))), "mix-alike")
    buckets = alike.groupBy("skey", "size", "b").agg(F.sum("alike").alias("in_bucket"))
    ahead = Window.partitionBy("skey", "size").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("ahead", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0))).join(cells, ["skey", "size"])
    turn = F.sum("alike").over(Window.partitionBy("skey", "size", "b").orderBy("h", "doc_id", "origin"))
    ranked = alike.withColumn("turn", turn).join(buckets, ["skey", "size", "b"])
    base = F.floor(F.col("m") / F.col("n"))
    more = F.greatest(F.lit(0), F.least(F.col("alike"), F.col("m") % F.col("n") - (F.col("ahead") + F.col("turn") - F.col("alike"))))
    kinds = F.array(F.struct((base + 1).alias("copies"), more.alias("rows")), F.struct(base.alias("copies"), (F.col("alike") - more).alias("rows")))
    return ranked.select("doc_id", "source", "size", "source_size", "target", "rate", "h", F.explode(kinds).alias("k")).select("doc_id", "source", "size", "source_size", "target", "rate", "h", F.col("k.copies").alias("copies"), F.col("k.rows").alias("rows")).filter("rows > 0")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, steps: int = 60, tolerance: float = 1e-9) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, rate, copies, taken."""
    rows = mix_alike(docs, id_col, text_col, source_col, weights, max_copies, steps, tolerance)
    rows = rows.withColumn("one", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return rows.select("doc_id", "source", "size", "source_size", "target", "rate", F.col("copies").cast("long").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"))
