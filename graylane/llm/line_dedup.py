"""Line dedup: a suffix array over line ids by distributed prefix doubling (DataFrame operations only).

1. Each line of each text is a symbol, named by two 64-bit hashes; its rank is its place among the distinct lines. Only
   lines that stand more than once can be part of a repeated run; stretches of such lines that are too short for a run
   leave as well. What follows works on the stretches alone, on (place in the sequence of all lines, rank) pairs.
2. Prefix doubling: a round ranks the pairs (rank at i, rank at i + k). The distinct pairs are sorted over all partitions
   and numbered in that order, so a rank is the place of the first 2 k lines of a suffix in the suffix array. Suffixes
   whose rank is their own have no common prefix of 2 k lines with another and leave; rounds go on as long as a run of
   2 k lines or more is looked for from a suffix that is left.
3. A run qualifies by its lines (min_lines) or its words (more than min_words, runs of characters other than white space;
   one line of so many is enough). The shortest qualifying run from each line on and the shortest one up to each line
   are looked up; together they cover every qualifying repeated run, as its last lines may be too short for one of their
   own. The suffixes that share a run of n lines, k <= n < 2 k, are the interval of the suffix array with a longest common
   prefix of n or more; they are those with the same rank of the first k and of the last k lines of the run.
4. In each interval the first suffix (in the order of documents and lines) stays; the run that starts at any later one is
   deleted. Neighbouring and overlapping runs merge into the maximal ones. Copies may overlap the run that stays, as in a
   text that repeats with a period: every line of a later copy goes, also where it ends the first (with runs of three
   lines `a b a b a` keeps `a b`, which the deleted lines repeat in turn).

Very common lines are dealt out by a second key where lines meet their ranks. Texts are read twice, for their lines and
for the result, and neither written nor taken apart: the lines that go are stretches, looked up by the id and a hash of
the text, and the pieces between them are joined. The table must give the same rows each time.

Defined cases: a null text has no lines and stays null; an empty text has one empty line; documents are ordered by
doc_id (null first), then by a hash of the text, so rows with one id have a fixed order; a run doesn't cross from a
document into the next; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graylane.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: A key of more rows is split where rows meet their ranks; at most HOT_KEYS keys are split (24 MB broadcast).
HOT_ROWS, HOT_KEYS = 20_000, 1_000_000
#: Up to so many stretches of deleted lines (some 60 MB with the keys of their texts) are broadcast to the texts; beyond, both meet by a shuffle.
SEND_IDS = 500_000


def shared_ranks(rows: DataFrame, keys: list[str], deal: list[str], first: str | None = None) -> DataFrame:
    """Those of rows whose keys stand in several rows, with rank, the order of their keys among the distinct ones, and the least value of a column with these keys (as first).

    deal: columns that tell the rows of a very common key apart, by which these are dealt out.
    """
    names = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("many"), *([F.min(first).alias("first")] if first else [])).filter("many > 1")
    names = written(names.sort(*keys).withColumn("rank", F.monotonically_increasing_id()), "lines-ranks")
    least = max(HOT_ROWS, (names.agg(F.sum("many")).first()[0] or 0) // HOT_KEYS)
    hot = names.filter(F.col("many") > least)
    parts = F.floor(F.col("many") / least + 1).cast("int")
    if hot.isEmpty():
        return rows.join(names.drop("many"), keys)
    dealt = rows.join(F.broadcast(hot.select(*keys, parts.alias("parts"))), keys, "left").withColumn("deal", F.pmod(F.xxhash64(*deal), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    names = names.withColumn("deal", F.explode(F.sequence(F.lit(0), F.when(F.col("many") > least, parts - 1).otherwise(0))))
    return dealt.join(names.drop("many"), [*keys, "deal"]).drop("deal")


def bases(heads: DataFrame) -> DataFrame:
    """(rid, base): the place of each document's first line in the sequence of all lines, documents in the order of doc_id (null first), h and rid; one place between documents stays free."""
    sizes = heads.select("rid", "doc_id", "h", (F.col("n_lines") + 1).alias("places"))
    rows = written(sizes.orderBy(F.col("doc_id").asc_nulls_first(), "h", "rid").select("rid", "places", F.monotonically_increasing_id().alias("mark")), "lines-order")
    rows = rows.withColumn("part", F.shiftright("mark", 33))
    # a row for each range of the sort, of which there are as many as shuffle partitions
    parts = rows.groupBy("part").agg(F.sum("places").alias("all"))
    before = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before"))
    within = F.sum("places").over(Window.partitionBy("part").orderBy("mark")) - F.col("places")
    return rows.withColumn("within", within).join(F.broadcast(before), "part").select("rid", (F.col("before") + F.col("within")).alias("base"))


def line_count() -> Column:
    return F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1


def stretches(lines: DataFrame, min_lines: int | None, min_words: int | None) -> DataFrame:
    """lines with stretch, neighbouring shared lines, without stretches too short for any run."""
    by_line = Window.partitionBy("rid").orderBy("line")
    lines = lines.withColumn("stretch", F.col("line") - F.row_number().over(by_line))
    whole = Window.partitionBy("rid", "stretch")
    long_enough = F.lit(False)
    if min_lines is not None:
        long_enough |= F.count(F.lit(1)).over(whole) >= min_lines
    if min_words is not None:
        long_enough |= F.sum("words").over(whole) > min_words
    return lines.withColumn("keep", long_enough).filter("keep").drop("keep")


def shortest_runs(lines: DataFrame, min_lines: int | None, min_words: int | None) -> DataFrame:
    """(pos, n) of the shortest qualifying run from each line on and up to each line, within its stretch."""
    whole = Window.partitionBy("rid", "stretch")
    on = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.select("rid", "stretch", "pos", "words").withColumn("i", F.row_number().over(whole.orderBy("pos")) - 1).withColumn("m", F.count(F.lit(1)).over(whole).cast("int"))
    ends, starts = [], []
    if min_words is not None:
        lines = lines.withColumn("upto", F.sum("words").over(on)).withColumn("all", F.sum("words").over(whole))
        lines = lines.withColumn("before", F.col("upto") - F.col("words")).withColumn("after", F.col("all") - F.col("upto"))
        reach = lambda c: F.count(F.lit(1)).over(whole.orderBy(c).rangeBetween(Window.unboundedPreceding, min_words)).cast("int")
        ends.append(F.when(F.col("all") - F.col("before") > min_words, reach("before")))
        starts.append(F.when(F.col("all") - F.col("after") > min_words, F.col("m") - reach("after")))
    if min_lines is not None:
        ends.append(F.when(F.col("i") + min_lines <= F.col("m"), F.col("i") + min_lines))
        starts.append(F.when(F.col("i") + 1 >= min_lines, F.col("i") + 1 - min_lines))
    lines = lines.withColumn("end", F.least(*ends) if len(ends) > 1 else ends[0]).withColumn("start", F.greatest(*starts) if len(starts) > 1 else starts[0])
    runs = F.array(F.struct("pos", (F.col("end") - F.col("i")).alias("n")), F.struct((F.col("pos") - F.col("i") + F.col("start")).alias("pos"), (F.col("i") + 1 - F.col("start")).alias("n")))
    return lines.select(F.explode(runs).alias("run")).select("run.*").filter("n is not null").distinct()


def later_runs(now: DataFrame, runs: DataFrame) -> DataFrame:
    """Those of runs (pos, n) that are later copies; now: (pos, rank) of the lines in stretches."""
    k, later = 1, []
    while True:
        runs = written(runs.join(now, "pos").select("pos", "n", F.col("rank").alias("a")), "lines-runs")
        ready = runs.filter(F.col("n") < 2 * k).withColumn("there", F.col("pos") + F.col("n") - k)
        ready = ready.join(now.select(F.col("pos").alias("there"), F.col("rank").alias("b")), "there").drop("there")
        later.append(shared_ranks(ready, ["n", "a", "b"], ["pos"], "pos").filter(F.col("first") < F.col("pos")).select("pos", "n"))
        runs = runs.filter(F.col("n") >= 2 * k).select("pos", "n")
        if runs.isEmpty():
            return functools.reduce(DataFrame.unionByName, later)
        pair = now.select("pos", F.col("rank").alias("a")).join(now.select((F.col("pos") - k).alias("pos"), F.col("rank").alias("b")), "pos")
        now = written(shared_ranks(pair, ["a", "b"], ["pos"]).select("pos", "rank"), "lines-suffixes")
        k *= 2


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int | None = 2, min_words: int | None = 50) -> tuple[DataFrame, DataFrame]:
    """(a row for each text that isn't null: rid, doc_id, h, n_lines; later copies of runs: rid, line, n)."""
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    texts = texts.select("rid", "doc_id", "h", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    head = lambda c: F.when(F.col("line") == 0, F.col(c)).alias(c)
    words = F.regexp_count("text", F.lit(WORD)) if min_words is not None else F.lit(0)
    lines = texts.select("rid", head("doc_id"), head("h"), "line", F.xxhash64("text").alias("a"), F.xxhash64(F.lit("line"), F.reverse("text")).alias("b"), words.alias("words"))
    lines = written(lines, "lines-lines")
    sizes = lines.groupBy("rid").agg(F.count(F.lit(1)).alias("n_lines"))
    heads = lines.filter("line = 0").select("rid", "doc_id", "h")
    heads = written(heads.join(sizes, "rid"), "lines-heads")
    now = stretches(shared_ranks(lines.select("rid", "line", "a", "b", "words"), ["a", "b"], ["rid", "line"]).drop("a", "b"), min_lines, min_words)
    now = written(now.join(bases(heads), "rid").withColumn("pos", F.col("base") + F.col("line")).drop("base"), "lines-stretches")
    later = later_runs(now.select("pos", "rank"), shortest_runs(now, min_lines, min_words))
    return heads, later.join(now.select("pos", "rid", "line"), "pos").select("rid", "line", "n")


def cut_text(text: Column, cuts: Column, n_lines: Column) -> Column:
    """text without the lines of cuts (ascending stretches from, end)."""
    from_ = F.concat(F.array(F.lit(0)), cuts["end"])
    to = F.concat(cuts["from"], F.array(n_lines.cast("int")))
    # the text is split once for all stretches, as the element of an array of one
    kept = lambda lines: F.array_join(F.flatten(F.zip_with(from_, to, lambda a, b: F.slice(lines, a + 1, b - a))), "\n")
    return F.transform(F.array(F.split(text, "\n", -1)), kept)[0]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int | None = 2, min_words: int | None = 50) -> DataFrame:
    """For each row of docs: doc_id, text (without later copies; null only if it was null), n_lines, n_deleted, n_runs (maximal deleted runs)."""
    heads, later = repeated_runs(docs, id_col, text_col, min_lines, min_words)
    # what a run adds to those that start before it; a run that begins where the others end only lengthens them
    ahead = Window.partitionBy("rid").orderBy("line", "n").rowsBetween(Window.unboundedPreceding, -1)
    later = later.withColumn("end", F.col("line") + F.col("n")).withColumn("upto", F.coalesce(F.max("end").over(ahead), F.lit(-1)))
    added = later.withColumn("from", F.greatest("line", "upto")).filter("from < end").select("rid", F.col("from").cast("int"), F.col("end").cast("int"), (F.col("line") > F.col("upto")).alias("new"))
    cuts = F.sort_array(F.collect_list(F.struct("from", "end"))).alias("cuts")
    added = added.groupBy("rid").agg(cuts, F.sum(F.col("end") - F.col("from")).alias("n_deleted"), F.count_if("new").alias("n_runs"))
    # rows with one id and text are alike but for their place: the first keeps what the others all lose, so a key has two kinds at most
    kinds = heads.join(added, "rid", "left").groupBy("doc_id", "h", "cuts", "n_deleted", "n_runs").agg(F.count(F.lit(1)).alias("copies"))
    kinds = kinds.groupBy("doc_id", "h").agg(F.collect_list(F.struct("cuts", "n_deleted", "n_runs", "copies")).alias("kinds")).filter(F.exists("kinds", lambda k: k["cuts"].isNotNull()))
    kinds = written(kinds.withColumn("alone", (F.size("kinds") == 1) & (F.col("kinds")[0]["copies"] == 1)), "lines-cuts")
    n_cuts = kinds.agg(F.sum(F.aggregate("kinds", F.lit(0), lambda n, k: n + F.coalesce(F.size(k["cuts"]), F.lit(0))))).first()[0] or 0
    sent = F.broadcast if n_cuts <= SEND_IDS else lambda df: df

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    n_lines = F.coalesce(line_count(), F.lit(0)).cast("long")

    def meet(by_key: DataFrame, how: str) -> DataFrame:
        by_key = by_key.withColumnsRenamed({"doc_id": "k_id", "h": "k_h"})
        return texts.join(sent(by_key), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h")), how)

    def result(rows: DataFrame) -> DataFrame:
        counts = [F.coalesce(F.col("kind")[c], F.lit(0)).cast("long").alias(c) for c in ("n_deleted", "n_runs")]
        text = F.when(F.col("kind.cuts").isNull(), F.col("text")).otherwise(cut_text(F.col("text"), F.col("kind.cuts"), n_lines))
        return rows.select("doc_id", text.alias("text"), n_lines.alias("n_lines"), *counts)

    out = result(meet(kinds, "left").filter("alone is null or alone").withColumn("kind", F.col("kinds")[0]))
    twice = kinds.filter("not alone")
    if twice.isEmpty():
        return out
    once = meet(twice.select("doc_id", "h"), "left_semi").groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    once = once.join(twice.select(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"), "kinds"), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h")))
    again = once.select("doc_id", "text", F.explode("kinds").alias("kind")).select("doc_id", "text", "kind", F.explode(F.sequence(F.lit(1), F.col("kind.copies").cast("int"))).alias("i"))
    return out.unionByName(result(again))
