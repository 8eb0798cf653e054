"""A Merkle manifest of a table, and proofs of its rows by a recursive query.

Each row is a leaf: the SHA-256 of its fields, each `-` if null, else its UTF-8 byte count, `:` and its value. The leaves of
a group ascend by the order column; every two consecutive nodes become one (a last one alone becomes the digest of itself)
until one is left, the group's subroot. The subroots, by group (null first), are the leaves of one more tree: the root.
Digests are hashed as lower-case hex text and stored as 32 bytes.

Levels are built bottom up, STEP of them in one grouping of 2**STEP consecutive nodes, and stored as link rows: a link
stands for a node and holds the siblings on the way to the ancestor STEP levels up, its digest and its key (step=1 stores
plain parents). Leaves are numbered without a global sort in one task: ranges are sorted, counted, and the counts summed.

A recursive common table expression climbs the links: it starts from each leaf with what is claimed of it, and each turn
joins the next link, appends its siblings and folds the claimed digest with them, until there is no ancestor. Links
near the root serve many leaves, so each has a copy for every 2**PART leaves below it: no join key has more rows.

Defined cases: null fields have a code of their own; rows with one order value are ordered by their digest (null order
first); equal rows are leaves of their own with proofs of their own; a group of one row has that row's leaf as its subroot;
an empty table has no root and gives no rows; further columns are ignored. The session's limit of rows in a recursive
query (spark.sql.cteRecursionRowLimit) is lifted and stays so; its limit of 100 turns is far above the number of steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graylane.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one link spans, and the power of two of the leaves that share one copy of a link.
STEP, PART = 8, 16
_SHIFT = 33  # monotonically_increasing_id() has the partition above, the row below

_HASH = "unhex(sha2({}, 256))"
_FOLD = f"""aggregate(transform({{path}}, (s, j) -> struct(s as s, shiftright({{place}}, j) & 1L as odd)), {{start}}, (acc, x) -> {_HASH.format(
    "case when x.s is null then lower(hex(acc)) when x.odd = 1 then concat(lower(hex(x.s)), lower(hex(acc))) else concat(lower(hex(acc)), lower(hex(x.s))) end"
)})"""


@dataclass
class Manifest:
    """leaves: the order column, leaf, claimed and the link of each row; nodes: the links of all other stored nodes, with their copies."""

    leaves: DataFrame
    nodes: DataFrame


def leaf(fields: list[Column]) -> Column:
    """The digest of a row's fields."""
    text = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows (tree, ...) with idx, the place in its tree by the order columns, and n, the tree's number of rows."""
    rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id())
    rows = written(rows, "manifest-rows").withColumn("range", F.shiftright("at", _SHIFT))
    ranges = rows.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("k"), F.min("at").alias("first"))
    # a row for each range and tree
    upto, all_of = F.sum("k").over(Window.partitionBy("tree").orderBy("range")), F.sum("k").over(Window.partitionBy("tree"))
    ranges = written(ranges.select("tree", "range", (upto - F.col("k") - F.col("first")).alias("shift"), all_of.alias("n")), "manifest-ranges")
    return rows.join(ranges, ["tree", "range"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def linked(rows: DataFrame, step: int, last: int | None, level: int) -> DataFrame:
    """The links of one level's nodes (tree, idx, n, total, digest, ...): path, place, up_level, up_idx, up_digest. last: the level that a tree's root is called by."""
    rest = [c for c in rows.columns if c not in ("tree", "n", "total")]
    nodes = F.sort_array(F.collect_list(F.struct("idx", *[c for c in rest if c != "idx"])))
    out = rows.groupBy("tree", "n", "total", F.shiftright("idx", step).alias("block")).agg(nodes.alias("nodes"))
    out = out.withColumn("height", F.least(F.lit(step), F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)))
    out = out.withColumn("l0", F.expr("transform(nodes, x -> x.digest)"))
    for j in range(step):
        pair = _HASH.format(f"concat(lower(hex(get(l{j}, 2 * i))), coalesce(lower(hex(get(l{j}, 2 * i + 1))), ''))")
        out = out.withColumn(f"l{j + 1}", F.expr(f"case when height > {j} then transform(sequence(0, (size(l{j}) + 1) div 2 - 1), i -> {pair}) else l{j} end"))
    siblings = ", ".join(f"get(l{j}, shiftright(i, {j}) ^ 1)" for j in range(step))
    each = F.expr(f"transform(nodes, (x, i) -> struct(x as node, slice(array({siblings}), 1, height) as path))")
    out = out.select("tree", "n", "total", "block", F.col(f"l{step}")[0].alias("up_digest"), F.explode(each).alias("x"))
    end = F.col("n") <= 1 << step
    return out.select(
        "tree", "n", "total", *[f"x.node.{c}" for c in rest], "x.path", F.lit(level).alias("level"), F.col("x.node.idx").alias("place"),
        F.when(end, F.lit(last).cast("int")).otherwise(F.lit(level + step)).alias("up_level"), F.when(end, F.lit(0).cast("long")).otherwise(F.col("block")).alias("up_idx"), "up_digest",
    )


def _built(rows: DataFrame, step: int, last: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links of the leaves, links of the nodes above them, roots: tree, digest) of the trees of rows (tree, idx, n, digest, ...)."""
    most = rows.agg(F.max("n")).first()[0] or 0
    level, now = 0, written(linked(rows.withColumn("total", F.col("n")), step, last, 0), "manifest-leaves")
    leaves, above = now, []
    roots = [now.filter((F.col("n") <= 1 << step) & (F.col("idx") == 0)).select("tree", "total", F.col("up_digest").alias("digest"))]
    while most > 1 << step:
        level, most = level + step, -(-most // (1 << step))
        first = now.filter((F.col("n") > 1 << step) & (F.col("idx").bitwiseAND((1 << step) - 1) == 0))
        up = first.select("tree", F.ceil(F.col("n") / (1 << step)).alias("n"), "total", F.col("up_idx").alias("idx"), F.col("up_digest").alias("digest"))
        now = written(linked(up, step, last, level), "manifest-nodes")
        above.append(now)
        roots.append(now.filter((F.col("n") <= 1 << step) & (F.col("idx") == 0)).select("tree", "total", F.col("up_digest").alias("digest")))
    columns = ["tree", "total", "level", "idx", "path", "place", "up_level", "up_idx", "up_digest"]
    nodes = leaves.select(*columns).limit(0)
    for df in above:
        nodes = nodes.unionByName(df.select(*columns))
    found = roots[0]
    for df in roots[1:]:
        found = found.unionByName(df)
    return leaves, nodes, written(found, "manifest-roots")


def _copies(nodes: DataFrame) -> DataFrame:
    """nodes with part: a copy of each for every 2**PART leaves below it. A subroot (level -1) is above all leaves."""
    low, high = "idx << level", "least((idx + 1) << level, total)"
    first, last = F.expr(f"case when level < 0 then 0L else {low} end"), F.expr(f"case when level < 0 then total else {high} end")
    return nodes.withColumn("part", F.explode(F.sequence(F.shiftright(first, PART), F.shiftright(last - 1, PART))))


def climb(leaves: DataFrame, nodes: DataFrame, keep: list[str]) -> DataFrame:
    """For each leaf keep, path (all siblings to the root, null where there is none), subroot, root and folded: the claimed digest, folded with the siblings on its way."""
    spark = leaves.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    kept = ", ".join(f"c.`{k}`" for k in keep)
    fold = lambda link, start: _FOLD.format(path=f"{link}.path", place=f"{link}.place", start=start)
    return spark.sql(
        f"""
        WITH RECURSIVE climb AS (
          SELECT {kept}, c.tree, shiftright(c.idx, {PART}) AS part, c.up_level, c.up_idx, c.up_digest AS reached, cast(null AS binary) AS subroot, c.path, {fold("c", "c.claimed")} AS folded
          FROM {{leaves}} c
          UNION ALL
          SELECT {kept}, c.tree, c.part, n.up_level, n.up_idx, n.up_digest, CASE WHEN n.level < 0 THEN c.reached ELSE c.subroot END, concat(c.path, n.path), {fold("n", "c.folded")}
          FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.up_level = n.level AND c.up_idx = n.idx AND c.part = n.part
        )
        SELECT {kept}, c.path, c.subroot, c.reached AS root, c.folded FROM climb c WHERE c.up_level IS NULL""",
        leaves=leaves,
        nodes=nodes,
    )


def build(docs: DataFrame, claims: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", order_col: str = "doc_id", step: int = STEP) -> Manifest:
    """The manifest of docs, written. claims: by field, what is claimed of a row instead of its value."""
    stated = leaf([(claims or {}).get(c, F.col(c)) for c in fields])
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit("-"))
    rows = docs.select(tree.alias("tree"), F.col(order_col).alias("key"), leaf([F.col(c) for c in fields]).alias("digest"), stated.alias("claimed"))
    # texts are read and hashed once; ranges are found on the digests
    leaves, nodes, roots = _built(numbered(written(rows, "manifest-digests"), "key", "digest"), step, -1)
    # "-" would come after "+": the null group is named by an empty string, which is before every other
    tops = roots.select(F.lit("*").alias("tree"), F.when(F.col("tree") == "-", F.lit("")).otherwise(F.col("tree")).alias("name"), F.col("tree").alias("of"), F.col("total").alias("below"), "digest", F.col("digest").alias("claimed"))
    top, over, _ = _built(numbered(tops, "name"), step, None)
    proofs = climb(top, written(_copies(over), "manifest-nodes"), ["of", "below", "place"])
    subroots = proofs.select(F.col("of").alias("tree"), F.col("below").alias("total"), F.lit(-1).alias("level"), F.lit(0).cast("long").alias("idx"), "path", "place", F.lit(None).cast("int").alias("up_level"), F.lit(0).cast("long").alias("up_idx"), F.col("root").alias("up_digest"))
    return Manifest(leaves, written(_copies(nodes.unionByName(subroots)), "manifest-links"))


def proofs(manifest: Manifest) -> DataFrame:
    """For each row: key (the order column), leaf, subroot, root, proof (the siblings' digests from the leaf to the root), folded_root (from the claimed leaf), verified."""
    found = climb(manifest.leaves, manifest.nodes, ["key", "digest"])
    return found.select("key", F.col("digest").alias("leaf"), "subroot", "root", F.expr("filter(path, s -> s is not null)").alias("proof"), F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
