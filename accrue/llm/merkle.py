"""A Merkle manifest of a dataset, with a proof for every row.

Rows are leaves of one tree per key, in the order of their ids; runs of `FAN` nodes become their digest until one is left,
and the keys' tops are the leaves of the tree above. A row's rank, written in base `FAN`, is its path through the tree. So
the tree is a rollup: a block holds `FAN ** DEEP` consecutive leaves, and its digit columns are grouped away one after the
other, each grouping nesting the child structs of a node into an array and hashing them. A block is shuffled once; its
groupings need no exchange of their own. The tops of the blocks are the leaves of the next, much smaller, rollup, and so
on until one node is left. On the way down, a block meets the path of its own top by one more grouping, and `transform`
over the nested arrays and `explode` emit the path of each leaf.

Ranks come from a written range-sorted table: places within each of its parts, behind the parts before. No key, however
large, is held or ordered by one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from accrue.sources.shared import discard, written

FAN = 8
DEEP = 3
BITS = 3 * DEEP  # of a rank within its block
PART_ROWS, LEAST_ROWS, LEAST_WAYS = 1 << 17, 1 << 12, 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<before:string,after:string>"


def field(value: Column) -> Column:
    """`-` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; null stays null."""
    return F.translate(text, _UPPER, _LOWER)


def ranked(rows: DataFrame, order: list[str], part_rows: int = PART_ROWS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """`rows` with `rank` (from 0) and `n` (rows) within `tree`; nulls first, ties in any order.

    `rows` is a written table, since the sampling of the range partitions reads it once more; it is discarded. Small
    tables have parts of fewer rows, up to `LEAST_WAYS` parts.
    """
    table, rows = rows, rows.withColumn("_row", F.monotonically_increasing_id())
    total = rows.count()
    ways = max(1, -(-total // part_rows), min(LEAST_WAYS, -(-total // least_rows)))
    keys = [F.col(c).asc_nulls_first() for c in ["tree", *order, "_row"]]
    parts = written(rows.repartitionByRange(ways, *keys).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("tree", "_part").agg(F.count("*").alias("_size"))
    tree = Window.partitionBy("tree")
    before = F.sum("_size").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("tree").alias("_tree"), F.col("_part").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_size").over(tree).alias("n"))
    place = F.row_number().over(Window.partitionBy("tree", "_part").orderBy(*keys[1:]))
    placed = parts.withColumn("_place", place).join(sizes, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_of")))
    out = written(placed.withColumn("rank", F.col("_before") + F.col("_place") - 1).select(*table.columns, "n", "rank"), "ranked")
    discard(table, parts)
    return out


def _nested(nodes: DataFrame) -> DataFrame:
    """Blocks (tree, block, n, digest, node) of nodes (tree, rank, n, digest, load): the digit columns grouped away."""
    digit = lambda level: F.shiftright("rank", 3 * level).bitwiseAND(FAN - 1).cast("int")
    height = reduce(lambda a, b: a + b, [(F.col("n") > FAN**level).cast("int") for level in range(DEEP)])
    levels = [f"d{level}" for level in range(DEEP)]
    rows = nodes.select(
        "tree",
        F.shiftright("rank", BITS).alias("block"),
        "n",
        height.alias("height"),
        *[digit(level).alias(name) for level, name in enumerate(levels)],
        F.struct("digest", "load").alias("node"),
    ).repartition("tree", "block")
    for level, name in enumerate(levels):
        rows = rows.groupBy("tree", "block", "n", "height", *levels[level + 1 :]).agg(F.sort_array(F.collect_list(F.struct(name, "node"))).alias("run"))
        digests = F.transform("run", lambda c: c.node.digest)
        # above the top of a small tree there is one node, which stays as it is
        digest = F.when(F.col("height") > level, F.sha2(F.array_join(digests, ""), 256)).otherwise(F.element_at(digests, 1))
        rows = rows.select("tree", "block", "n", "height", *levels[level + 1 :], F.struct(digest.alias("digest"), F.col("run")).alias("node"))
    return rows.select("tree", "block", "n", "height", F.col("node.digest").alias("digest"), "node")


def _steps(node: Column, level: int) -> Column:
    """(load, path) of all leaves below a node: its run's other digests, before and after each child, at the path's end."""

    def child(c: Column, i: Column) -> Column:
        digests = F.transform(node.run, lambda x: x.node.digest)
        step = F.struct(F.array_join(F.slice(digests, F.lit(1), i), "").alias("before"), F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "").alias("after"))
        if level == 0:
            return F.array(F.struct(c.node.load.alias("load"), F.array(step).alias("path")))
        return F.transform(_steps(c.node, level - 1), lambda x: F.struct(x.load.alias("load"), F.concat(x.path, F.array(step)).alias("path")))

    return F.flatten(F.transform(node.run, child))


def rolled_up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rollups, from the leaves up, and (tree, digest) of the trees' tops.

    `nodes` has tree, rank, n, digest and load.
    """
    rollups = []
    while True:
        blocks = written(_nested(nodes), "blocks")
        rollups.append(blocks)
        nodes = blocks.select("tree", F.col("block").alias("rank"), F.shiftright(F.col("n") + (FAN**DEEP - 1), BITS).alias("n"), "digest", F.struct("tree", "block").alias("load"))
        if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
            return rollups, blocks.select("tree", "digest")


def proofs(rollups: list[DataFrame], above: DataFrame) -> DataFrame:
    """(load, path, top) of every leaf; `above` has tree, path (from the tree's top on) and top, a struct that is passed on."""
    above = above.select("tree", F.lit(0).cast("long").alias("block"), "path", "top")
    for blocks in reversed(rollups):
        nothing = [F.lit(None).cast(above.schema[c].dataType).alias(c) for c in ("path", "top")]
        below = blocks.select("tree", "block", F.struct("height", "node").alias("of"), *nothing)
        both = below.unionByName(above, allowMissingColumns=True)
        met = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("of", "path", "top")])
        leaf = met.select(F.explode(_steps(F.col("of.node"), DEEP - 1)).alias("leaf"), F.col("of.height").alias("height"), F.col("path").alias("rest"), "top")
        rows = leaf.select("leaf.load", F.concat(F.slice("leaf.path", F.lit(1), F.col("height")), F.col("rest")).alias("path"), "top")
        if blocks is rollups[0]:
            return rows
        above = rows.select("load.tree", "load.block", "path", "top")
    raise AssertionError("there is a rollup for the leaves at least")


def folded(leaf: Column, path: Column) -> Column:
    """The top that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step.before, digest, step.after), 256))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda step: F.concat(step.before, step.after)), "")


def manifest(leaves: DataFrame, order: list[str]) -> DataFrame:
    """(load, subroot, root, path) of every row of `leaves` (tree, digest, load and the `order` columns).

    Rows of one tree are ordered by `order`, nulls first, then by digest; rows equal in these are interchangeable. The
    trees are ordered by `tree`, null first, strings bytewise. An empty table gives no rows.
    """
    rows = ranked(written(leaves, "leaves"), [*order, "digest"])
    rollups, subroots = rolled_up(rows)
    discard(rows)
    tops = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("_key"), "digest", F.struct("tree", "digest").alias("load"))
    tops = ranked(written(tops, "subroots"), ["_key"])
    upper, root = rolled_up(tops)
    discard(tops)
    start = root.select("tree", F.array().cast(f"array<{STEP}>").alias("path"), F.struct("digest").alias("top"))
    keys = proofs(upper, start).select("load.tree", "path", F.struct(F.col("load.digest").alias("subroot"), F.col("top.digest").alias("root")).alias("top"))
    return proofs(rollups, keys).select("load", "top.subroot", "top.root", "path")


def document_manifest(docs: DataFrame, id_col: str = "doc_id", key: str = "lang", fields: tuple[str, ...] = ("source", "lang", "n_chars"), text: str = "text", tampered: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path, folded_root, verified) of every row.

    A leaf is the digest of the id, `fields` and the text. Where `tampered` holds, the proof is checked against the leaf
    of the text in lower case, else against the leaf itself. Null values are hashed as `-`, a null id comes first within
    its key and is a value of its own, as a null key is. Further columns of any name are left behind.
    """
    values = [F.col(id_col), *[F.col(c) for c in fields]]
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_digest(*values, lowered(F.col(text))))
    leaves = docs.select(F.col(key).alias("tree"), F.col(id_col).alias("_id"), leaf_digest(*values, F.col(text)).alias("digest"), other.alias("_other"))
    leaves = leaves.select("tree", "_id", "digest", F.struct(F.col("_id").alias("id"), F.col("digest").alias("leaf"), F.col("_other").alias("other")).alias("load"))
    out = manifest(leaves, ["_id"])
    found = out.select(F.col("load.id").alias(id_col), F.col("load.leaf").alias("leaf"), "subroot", "root", "path", folded(F.coalesce("load.other", "load.leaf"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
