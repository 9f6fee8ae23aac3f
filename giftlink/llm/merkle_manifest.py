"""Merkle manifest of a dataset: checkpointed levels, recomputed proofs.

Every row is a leaf. The leaves of a tree are numbered in order, and every two
consecutive nodes become the hash of both (a last one without partner becomes
the hash of itself alone) until one node remains. Trees are kept per language;
their roots are the leaves of one more tree, whose root stands for the table.

Only every ``SPAN``-th level is written. A node of a written level stands for
an aligned block of 2**SPAN nodes of the written level below. ``build`` hashes
each block up in memory and keeps its top only. ``proofs`` goes down again
from the roots: it regenerates the interior of each block from the block's
stored nodes, emits each node's siblings, followed by those that the block's
top has been given, and discards the interior. A block is the unit of work: at
most 2**SPAN rows of one tree, so neither a hot language nor the number of
rows makes a large group, and a lost task regenerates its blocks alone.

Rows are numbered without a window over a tree: sorted by ranges, they are
counted per (range, tree), and the few counts are summed up.

Defined results: a null field is ``-``, any other is its UTF-8 byte count, a
colon and its value; an empty text is ``0:``. A null language is a tree of its
own, before all others. Rows with equal or null ids are ordered (nulls first)
by id, then leaf; rows that are equal in all fields have equal leaves and
differ in place only. Texts of any length are hashed whole. An empty table has
no trees and gives no rows. Other columns are not read and do no harm.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from giftlink.llm import common

SPAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOKEN = 65  # a sibling in a path: its side (L, R) and 64 hex digits
ALONE = "-" * TOKEN
NODE = "tree string, pos long, size long, hash string"


def leaf(values: list[Column]) -> Column:
    """The hash of a row's fields."""
    def field(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in values]).cast("binary"), 256)


def tree_of(c: Column) -> Column:
    """A tree's key, never null and in the order null, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (tree, hash, the ``order`` columns, ...) with ``pos``, the
    place in the tree from 0, and ``size``, the tree's number of rows; written.
    Equal rows are told apart by where they are stored, so that a large group
    of them spreads over ranges."""
    ranges = (rows.withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange("tree", *order, "_row").sortWithinPartitions("tree", *order, "_row")
              .withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    ranges = common.written(ranges, name)
    in_tree = Window.partitionBy("tree")
    starts = (ranges.groupBy("tree", "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
              .select("tree", "_range", "_first", F.sum("_n").over(in_tree).alias("size"),
                      (F.sum("_n").over(in_tree.orderBy("_range")) - F.col("_n")).alias("_before")))
    return (ranges.join(starts, ["tree", "_range"])
            .withColumn("pos", F.col("_before") + F.col("_row") - F.col("_first"))
            .drop("_range", "_row", "_first", "_before"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def rises(size: int, base: int, span: int) -> int:
    """Levels from a block's nodes at level ``base`` to its top."""
    return max(0, min(span, (size - 1).bit_length() - base))


def interior(nodes: list[str], up: int) -> list[list[str]]:
    """The levels of one block, its stored nodes first."""
    levels = [nodes]
    for _ in range(up):
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def fold(start: str, path: str) -> str:
    """The root that a leaf and its siblings lead to."""
    for at in range(0, len(path), TOKEN):
        side, other = path[at], path[at + 1:at + TOKEN]
        start = sha(other + start if side == "L" else start + other if side == "R" else start)
    return start


def block_paths(nodes: list[str], up: int):
    """Every stored node's siblings inside its block, as a path."""
    levels = interior(nodes, up)[:up]
    for i in range(len(nodes)):
        path = []
        for below in levels:
            other = i ^ 1
            path.append(ALONE if other >= len(below) else ("L" if i & 1 else "R") + below[other])
            i >>= 1
        yield "".join(path)


def _in_order(table: pa.Table) -> tuple:
    return table.sort_by("pos"), int(table["size"][0].as_py())


def climb(nodes: DataFrame, base: int, span: int, name: str) -> DataFrame:
    """The written level above ``nodes``, which are at level ``base``."""
    def top(table: pa.Table) -> pa.Table:
        table, size = _in_order(table)
        last = interior(table["hash"].to_pylist(), rises(size, base, span))[-1]
        return pa.table({"tree": table["tree"][:1], "pos": [table["pos"][0].as_py() >> span], "size": [size],
                         "hash": last})
    blocks = nodes.select("tree", "pos", "size", "hash", F.shiftright("pos", span).alias("_block"))
    return common.written(blocks.groupBy("tree", "_block").applyInArrow(top, NODE), name)


def build(leaves: DataFrame, order: list[str], span: int = SPAN, name: str = "merkle") -> list[DataFrame]:
    """The written levels of a forest: ``leaves`` (tree, hash, the ``order``
    columns, ...) numbered, then every ``span``-th level up to the roots. The
    driver reads one number, the largest tree's size."""
    levels = [numbered(leaves, order, f"{name}-0")]
    largest = levels[0].agg(F.max("size")).first()[0] or 0
    base = 0
    while base < max(0, largest - 1).bit_length():
        levels.append(climb(levels[-1], base, span, f"{name}-{base + span}"))
        base += span
    return levels


def descend(nodes: DataFrame, above: DataFrame, base: int, span: int) -> DataFrame:
    """Paths (tree, pos, path, subroot, root) of ``nodes``, at level ``base``,
    from those of the written level ``above``."""
    def paths(table: pa.Table, top: pa.Table) -> pa.Table:
        table, size = _in_order(table)
        tail = top["path"][0].as_py()
        path = [p + tail for p in block_paths(table["hash"].to_pylist(), rises(size, base, span))]
        same = [top[c][0].as_py() for c in ("subroot", "root")]
        return pa.table({"tree": table["tree"], "pos": table["pos"], "path": path,
                         "subroot": [same[0]] * len(path), "root": [same[1]] * len(path)})
    blocks = nodes.select("tree", "pos", "size", "hash", F.shiftright("pos", span).alias("_block"))
    tops = above.withColumnRenamed("pos", "_block")
    return (blocks.groupBy("tree", "_block").cogroup(tops.groupBy("tree", "_block"))
            .applyInArrow(paths, "tree string, pos long, path string, subroot string, root string"))


def digests(leaves: DataFrame, above: DataFrame, span: int) -> DataFrame:
    """The last step down, for leaves (tree, pos, size, hash, doc_id, told):
    each row's proof is made, hashed, tried on the row as it is ``told`` now
    (null: unchanged), and discarded."""
    def check(table: pa.Table, top: pa.Table) -> pa.Table:
        table, size = _in_order(table)
        tail, subroot, root = (top[c][0].as_py() for c in ("path", "subroot", "root"))
        rest = "".join(tail[i + 1:i + TOKEN] for i in range(0, len(tail), TOKEN) if tail[i] != "-")
        nodes, proofs, folded, beyond = table["hash"].to_pylist(), [], [], {}
        for own, path, told in zip(nodes, block_paths(nodes, rises(size, 0, span)), table["told"].to_pylist()):
            inner = "".join(path[i + 1:i + TOKEN] for i in range(0, len(path), TOKEN) if path[i] != "-")
            proofs.append(sha(inner + rest))
            upto = fold(told or own, path)
            if upto not in beyond:  # rows of a block that reach the same node go on alike
                beyond[upto] = fold(upto, tail)
            folded.append(beyond[upto])
        return pa.table({"doc_id": table["doc_id"], "leaf": table["hash"], "subroot": [subroot] * len(nodes),
                         "root": [root] * len(nodes), "proof_sha256": proofs, "folded_root": folded,
                         "verified": [x == root for x in folded]})
    blocks = leaves.select("tree", "pos", "size", "hash", "doc_id", "told", F.shiftright("pos", span).alias("_block"))
    tops = above.withColumnRenamed("pos", "_block")
    kind = leaves.schema["doc_id"].dataType.simpleString()
    return (blocks.groupBy("tree", "_block").cogroup(tops.groupBy("tree", "_block"))
            .applyInArrow(check, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                 "folded_root string, verified boolean"))


class Manifest:
    """The written levels of a table's trees and of the tree of their roots."""

    def __init__(self, docs: DataFrame, told: Column | None = None, span: int = SPAN):
        """``told``: what a row's leaf is when it is checked later, where it
        is no longer the leaf that was entered (null: unchanged)."""
        fields = [F.col(c) for c in FIELDS]
        rows = docs.select(tree_of(F.col("lang")).alias("tree"), leaf(fields).alias("hash"), "doc_id",
                           (F.lit(None).cast("string") if told is None else told).alias("told"))
        self.span = span
        self.trees = build(rows, ["doc_id", "hash"], span, "merkle-rows")
        subroots = self.trees[-1].select(F.lit("").alias("tree"), "hash", F.col("tree").alias("lang"))
        self.top = build(subroots, ["lang"], span, "merkle-roots")

    def _down(self, levels: list[DataFrame], tops: DataFrame, upto: int) -> DataFrame:
        for k in range(len(levels) - 2, upto - 1, -1):
            tops = common.written(descend(levels[k], tops, k * self.span, self.span), "merkle-paths")
        return tops

    def _tree_paths(self) -> DataFrame:
        """For each tree: its root's path to the table's root."""
        root = self.top[-1].select("tree", "pos", F.lit("").alias("path"), F.col("hash").alias("root"),
                                   F.col("hash").alias("subroot"))
        paths = self._down(self.top, root, 0).select("pos", "path", "root")
        return (self.top[0].select("pos", F.col("lang").alias("tree"), F.col("hash").alias("subroot"))
                .join(paths, "pos").select("tree", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root"))

    def proofs(self) -> DataFrame:
        """(tree, pos, path, subroot, root) of every row: ``fold(leaf, path)``
        is the root. ``path`` has 65 characters a level: the sibling's side
        and hash, or dashes for a node without sibling."""
        return self._down(self.trees, self._tree_paths(), 0)

    def check(self) -> DataFrame:
        """Every row's leaf, roots and proof's hash, and the root that the row
        as told leads to."""
        tops = self._down(self.trees, self._tree_paths(), 1)
        return digests(self.trees[0], tops, self.span)


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row whose ``n_chars`` was raised by one; only where 7
    divides the CRC-32 of the row's id."""
    changed = [F.col(c) + F.lit(1) if c == "n_chars" else F.col(c) for c in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf(changed))


common.ship(__name__)
