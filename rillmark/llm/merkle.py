"""A Merkle manifest of a data set, with a proof for every row.

Each row is a leaf. Within a tree (rows of one language) leaves are ranked, and
two neighbours become their parent's hash, level by level; the trees' roots, in
order, are the leaves of the last tree.

A tree is rolled up in blocks of `BLOCK` leaves. A block's rows meet once, by a
shuffle on (tree, block); then the binary digits of the rank are grouped away one
after another, last digit first, and each group nests its two children in a
struct with their hash. All these groupings keep the shuffle's partitioning. The
blocks' hashes are the leaves of the next round, so no struct grows with the
table. Within a block proofs come from unfolding the nested struct, digit by
digit, without a join; above, a block's own proof is joined to the block, one row
for `BLOCK` leaves.

Ranks come from one range-partitioned sort: a row's place in its partition plus
the rows before that partition, so a tree with most of the rows is spread over
all tasks. Texts are hashed where they are read and never move.

Defined cases: a null in any column is hashed as `-`; leaves without id come
first in their tree; rows that repeat an id are ordered by their hash, and rows
alike in all columns are leaves of their own, so each gives a row; a null
language is a tree of its own, the first; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import bounded_broadcast, saved, shuffle_width

DIGITS = 10  # levels rolled up in one round
BLOCK = 2**DIGITS
#: Rows of (tree, partition) offsets broadcast at most.
OFFSETS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Hex SHA-256 of texts one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(**other: Column) -> Column:
    """A row's hash, of its own columns or of others in their place."""
    return digest(*[field(other.get(name, F.col(name))) for name in FIELDS])


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds `rank` (from 0 within a tree) and `size` (leaves of the tree).

    `order` may leave ties; those rows take any order among each other.
    """
    n = shuffle_width(rows.sparkSession)
    # Equal rows are told apart by where they were read, so a third of all rows may be equal.
    sorted_rows = (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(n, tree, *order, "_tie")
        .sortWithinPartitions(tree, *order, "_tie")
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = saved(sorted_rows.withColumn("_part", F.shiftright("_at", 33)), "merkle-ranked")
    parts = placed.groupBy(F.col(tree).alias("_tree"), F.col("_part").alias("_p")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per tree and partition it lies in: a tree's window holds no more rows than there are partitions.
    tree_parts = Window.partitionBy("_tree")
    so_far = tree_parts.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(
        parts.select(
            "_tree", "_p", "_first", F.sum("_rows").over(tree_parts).alias("size"),
            F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before"),
        ),
        "merkle-offsets",
    )
    small = bounded_broadcast(offsets, offsets.count(), OFFSETS)
    here = (F.col(tree) == F.col("_tree")) & (F.col("_part") == F.col("_p"))
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(small, here).select(*rows.columns, rank.alias("rank"), "size")


def _level_up(kids: Column, level: int) -> Column:
    """The parent's hash; a tree that is down to one node by this level hands it on."""
    # A tree of 2^level leaves or fewer has one node here.
    joined = F.sha2(F.array_join(F.transform(kids, lambda k: k["h"]), "").cast("binary"), 256)
    return F.when(F.col("size") > F.lit(2**level).cast("long"), joined).otherwise(F.get(kids, F.lit(0))["h"])


def _blocks(leaves: DataFrame, low: int) -> DataFrame:
    """tree, size, block, node: blocks of leaves as nested structs, `low` levels of the tree lying below."""
    n = shuffle_width(leaves.sparkSession)
    digits = [F.shiftright("rank", d).bitwiseAND(F.lit(1).cast("long")).cast("int").alias(f"d{d}") for d in range(DIGITS)]
    rows = leaves.select(
        "tree", "size", F.shiftright("rank", DIGITS).alias("block"), *digits, F.struct("h", "carried").alias("node")
    ).repartition(n, "tree", "block")
    for d in range(DIGITS):
        keys = ["tree", "size", "block", *[f"d{i}" for i in range(d + 1, DIGITS)]]
        # Two children at most, and no shuffle: rows of a block are together already.
        grouped = rows.groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct(F.col(f"d{d}").alias("digit"), "node"))).alias("pair")
        )
        kids = F.transform("pair", lambda x: x["node"])
        rows = grouped.withColumn("kids", kids).select(*keys, F.struct(_level_up(F.col("kids"), low + d).alias("h"), "kids").alias("node"))
    return rows


def _unfold(blocks: DataFrame, low: int) -> DataFrame:
    """tree, size, rank, carried, path: every leaf of the blocks with its siblings from itself up.

    A step of a path is the sibling's hash, empty where there is none, and
    whether it stands on the left. Blocks carry the path above them.
    """
    rows = blocks.withColumn("rank", F.col("block"))
    for d in reversed(range(DIGITS)):
        kids = F.transform(
            F.col("node.kids"),
            lambda k, i: F.struct(
                k.alias("node"), i.cast("long").alias("digit"),
                F.struct(
                    F.coalesce(F.get(F.col("node.kids"), 1 - i)["h"], F.lit("")).alias("h"), (i == 1).alias("left")
                ).alias("step"),
            ),
        )
        real = F.col("size") > F.lit(2 ** (low + d)).cast("long")  # else the node was handed on
        rows = rows.select("tree", "size", "rank", "path", F.explode(kids).alias("kid")).select(
            "tree", "size", (F.col("rank") * 2 + F.col("kid.digit")).alias("rank"), F.col("kid.node").alias("node"),
            F.when(real, F.concat(F.array("kid.step"), "path")).otherwise(F.col("path")).alias("path"),
        )
    return rows.select("tree", "size", "rank", F.col("node.h").alias("h"), F.col("node.carried").alias("carried"), "path")


NO_PATH = "array<struct<h:string,left:boolean>>"


def prove(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, root, size) of every tree, and its leaves with their paths to the root.

    `leaves`: tree, size, rank, h and `carried`, a struct handed through.
    """
    rounds, low, at = [], 0, leaves
    while True:
        blocks = saved(_blocks(at, low), "merkle-blocks")
        rounds.append((blocks, low))
        low += DIGITS
        # One row comes to the driver: whether any tree has more than one block.
        if blocks.where("block > 0").isEmpty():
            break
        at = blocks.select(
            "tree", "size", F.col("block").alias("rank"), F.col("node.h").alias("h"), F.struct("block").alias("carried")
        )
    roots = rounds[-1][0].select("tree", F.col("node.h").alias("root"), "size")
    above = F.array().cast(NO_PATH)
    top, low = rounds[-1]
    paths = _unfold(top.withColumn("path", above), low)
    for blocks, low in reversed(rounds[:-1]):
        held = paths.select(F.col("tree").alias("_t"), F.col("rank").alias("_b"), "path")
        met = blocks.join(held, (F.col("tree") == F.col("_t")) & (F.col("block") == F.col("_b")))
        paths = _unfold(met, low)
    return roots, paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(
        path, leaf,
        lambda h, s: F.sha2(F.when(s["left"], F.concat(s["h"], h)).otherwise(F.concat(h, s["h"])).cast("binary"), 256),
    )


def manifest(docs: DataFrame, tampered: Column | None = None, changed: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per document.

    Where `tampered` holds, `folded_root` is worked out from the row with the
    columns `changed`, and `verified` says whether that still gives the root.
    """
    own = leaf_hash()
    shown = own if tampered is None else F.when(F.coalesce(tampered, F.lit(False)), leaf_hash(**(changed or {})))
    leaves = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        own.alias("h"), shown.alias("shown"),
    )
    placed = ranked(leaves, "tree", ["doc_id", "h", "shown"])
    subroots, paths = prove(
        placed.select("tree", "size", "rank", "h", F.struct("doc_id", F.coalesce("shown", "h").alias("shown")).alias("carried"))
    )
    subroots = saved(subroots, "merkle-subroots")
    tops = ranked(subroots.select(F.lit("").alias("all"), F.col("tree").alias("lang_key"), F.col("root").alias("h")), "all", ["lang_key"])
    roots, above = prove(
        tops.select(F.col("all").alias("tree"), "size", "rank", "h", F.struct("lang_key").alias("carried"))
    )
    root = roots.select("root").first()  # of the one last tree
    upper = saved(
        above.select(F.col("carried.lang_key").alias("_lang"), F.col("h").alias("subroot"), F.col("path").alias("_above")),
        "merkle-upper",
    )
    # One row per language; a language column full of noise is joined by a shuffle instead.
    small = bounded_broadcast(upper, upper.count(), OFFSETS)
    whole = paths.join(small, F.col("tree") == F.col("_lang")).withColumn("path", F.concat("path", "_above"))
    top = F.lit(None if root is None else root["root"]).cast("string")
    back = folded(F.col("carried.shown"), F.col("path"))
    return whole.select(
        F.col("carried.doc_id").alias("doc_id"), F.col("h").alias("leaf"), "subroot", top.alias("root"),
        F.sha2(F.array_join(F.transform("path", lambda s: s["h"]), "").cast("binary"), 256).alias("proof_sha256"),
        back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
