"""Operator 11: Merkle manifest of a dataset, with a proof per row.

Rows of a source, in the order of their ids, are the leaves of a tree whose nodes hash runs of
``arity`` children; the sources' roots are the leaves of one last tree. A tree is built in rounds.
A round deals its nodes to aligned blocks of ``arity ** levels`` and keeps each level of a block as
one hex string: fixed-width substrings of a level are hashed to the next, and the substrings that
flank a node within its run are its siblings. What a block reduces to is a node of the next round,
so that a source of any size, hot ones too, is spread over blocks, and rounds grow with the
logarithm of the largest source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

#: Hex digits of a digest.
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(fields: Sequence[str | Column]) -> Column:
    """SHA-256 over the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    parts = []
    for f in fields:
        value = (F.col(f) if isinstance(f, str) else f).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_hash(path: Column) -> Column:
    """SHA-256 over a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with _pos, their place among the rows of their _tree by ``order``, and _n, the tree's size.

    Rows are dealt to ranges, so that no tree is sorted in one task; a place is the place in the range
    plus the tree's rows in the ranges before.
    """
    keys = ["_tree", *order]
    placed, _ = store(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "merkle-placed")
    part = F.shiftright("_at", 33).alias("_part")
    # one row for each tree in each range: as many as trees and ranges together
    runs = placed.groupBy("_tree", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("_tree")
    before = F.coalesce(F.sum("_rows").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("_tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(tree).alias("_n"))
    return placed.withColumn("_part", part).join(runs, ["_tree", "_part"]).withColumn("_pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _parents(level: Column, arity: int) -> Column:
    """The level above: each fixed-width substring of ``arity`` digests becomes its hash."""
    width = WIDTH * arity
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / width).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)), "").cast("binary")


def _path(levels: Column, at: Column, arity: int, depth: int) -> Column:
    """Siblings of the node at place ``at`` of a block, a pair of flanking substrings for each level but the last."""
    spans = F.array(*[F.lit(arity**j) for j in range(depth + 1)])

    def step(level: Column, j: Column) -> Column:
        node = F.floor(at / F.get(spans, j)).cast("int")
        first = node - node % arity
        left = F.substring(level, first * WIDTH + 1, (node - first) * WIDTH)
        right = F.substring(level, (node + 1) * WIDTH + 1, (first + arity - 1 - node) * WIDTH)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def _blocks(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """Nodes (_tree, _pos, _n, _digest, _payload) by aligned block, with the block's levels.

    Columns: _tree, _block, _n, _nodes (by place: _at, _payload), _levels (hex strings as bytes), _top.
    """
    size = arity**depth
    blocks = nodes.groupBy("_tree", "_n", F.floor(F.col("_pos") / size).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("_pos") % size).cast("int").alias("_at"), "_digest", "_payload"))).alias("_nodes"))
    base = F.array_join(F.transform("_nodes", lambda d: d["_digest"]), "").cast("binary")
    # a tree with more than one block uses all levels of a block, the last block's too
    ups = F.lit(0)
    for j in range(depth):
        ups += F.when(F.col("_n") > arity**j, 1).otherwise(0)
    rounds = F.when(ups > 0, F.sequence(F.lit(1), ups)).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(rounds, F.array(F.col("_base")), lambda done, _: F.array_append(done, _parents(F.element_at(done, -1), arity)))
    blocks = blocks.withColumn("_base", base).withColumn("_levels", levels)
    return blocks.select(
        "_tree", "_block", "_n", F.transform("_nodes", lambda d: F.struct(d["_at"], d["_payload"])).alias("_nodes"),
        "_levels", F.element_at("_levels", -1).cast("string").alias("_top"))


def _prove(nodes: DataFrame, largest: int, arity: int, depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (_tree, _root) of the trees of ``nodes``, the largest of which has so many, and the blocks of each round."""
    blocks, _ = store(_blocks(nodes, arity, depth), "merkle-blocks")
    size = arity**depth
    if largest <= size:
        return blocks.select("_tree", F.col("_top").alias("_root")), [blocks]
    up = blocks.select("_tree", F.col("_block").alias("_pos"), F.ceil(F.col("_n") / size).alias("_n"), F.col("_top").alias("_digest"), F.struct("_block").alias("_payload"))
    roots, above = _prove(up, -(-largest // size), arity, depth)
    return roots, [blocks, *above]


def _paths(rounds: list[DataFrame], ends: DataFrame, arity: int, depth: int) -> DataFrame:
    """_tree, _payload and _path of the first round's nodes, up to the end of ``ends`` (_tree, _rest, others)."""
    blocks, above = rounds[0], rounds[1:]
    if above:
        # this round's blocks are the next one's nodes
        upper = _paths(above, ends, arity, depth).select("_tree", F.col("_payload._block").alias("_block"), F.col("_path").alias("_rest"), *[c for c in ends.columns if c not in ("_tree", "_rest")])
        blocks = blocks.join(upper, ["_tree", "_block"])
    else:
        blocks = blocks.join(ends, "_tree")
    kept = [c for c in ends.columns if c not in ("_tree", "_rest")]
    node = F.explode(F.transform("_nodes", lambda d: F.struct(d["_payload"], _path(F.col("_levels"), d["_at"], arity, depth).alias("_in")))).alias("_node")
    return blocks.select("_tree", "_rest", *kept, node).select(
        "_tree", F.col("_node._payload").alias("_payload"), F.concat("_node._in", "_rest").alias("_path"), *kept)


def _largest(placed: DataFrame) -> int:
    return placed.agg(F.coalesce(F.max("_n"), F.lit(0)).alias("n")).first()["n"]


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: Mapping[str, Column] | None = None,
    arity: int = 3,
    levels: int = 6,
) -> DataFrame:
    """Leaf, roots and proof of every row.

    Columns: id, source, leaf (hash of ``fields``), position (place in its source, from 0), subroot (its
    source's root), root, path (an array of left and right siblings as hex text, level by level up to
    the root: ``fold(leaf, path)`` gives the root) and the ``carry`` columns, computed from the row.

    Null fields hash as ``-`` and differ from empty ones; a null source is a source, before all others;
    null ids come first; rows of equal ids are ordered by their leaves, and equal rows are leaves each
    (which of them has which place doesn't matter). A lone leaf is its source's root, a lone source's
    root is the root; an empty table gives no rows. Other columns of any name are not read. ``levels``
    levels make a block: a task holds ``arity ** levels`` digests at a time.
    """
    carry = dict(carry or {})
    tree = F.when(F.col(source_col).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source_col).cast("string")))  # null first
    rows = docs.select(
        tree.alias("_tree"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), leaf_hash(fields).alias("_digest"),
        F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("_carry"), F.monotonically_increasing_id().alias("_row"))
    rows, _ = store(rows, "merkle-leaves")  # texts are read once
    placed = _positions(rows, ["_id", "_digest", "_row"])
    nodes = placed.select("_tree", "_pos", "_n", "_digest", F.struct("_id", "_source", "_pos", "_digest", "_carry").alias("_payload"))
    subroots, rounds = _prove(nodes, _largest(placed), arity, levels)
    # the sources' roots are the leaves of one more tree
    tops = subroots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_id"), F.col("_root").alias("_digest"))
    tops = _positions(tops, ["_id"])
    nodes = tops.select("_tree", "_pos", "_n", "_digest", F.struct("_id", "_digest").alias("_payload"))
    root, above = _prove(nodes, _largest(tops), arity, levels)
    ends = _paths(above, root.withColumn("_rest", F.array().cast("array<struct<left:string,right:string>>")), arity, levels)
    ends, _ = store(ends.select(F.col("_payload._id").alias("_tree"), F.col("_payload._digest").alias("_subroot"), "_root", F.col("_path").alias("_rest")), "merkle-roots")
    proved = _paths(rounds, ends, arity, levels)
    return proved.select(
        F.col("_payload._id").alias(id_col), F.col("_payload._source").alias(source_col), F.col("_payload._digest").alias("leaf"),
        F.col("_payload._pos").alias("position"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_path").alias("path"),
        *[F.col(f"_payload._carry.{n}").alias(n) for n in carry])


def without(column: str, chars: str, where: Column) -> Column:
    """``column`` with every character of ``chars`` deleted in the rows ``where`` holds: a way to tamper."""
    return F.when(where, F.translate(column, chars, "")).otherwise(F.col(column))


def audit(docs: DataFrame, changed: Mapping[str, Column], fields: Sequence[str] = FIELDS, id_col: str = "doc_id", **how) -> DataFrame:
    """Fold the leaves of changed rows with the siblings of the unchanged table.

    ``changed`` gives the altered fields. Columns: id, leaf, subroot, root, proof_sha256 (all of the table as
    it is), folded_root (of the altered row) and verified (whether that is the root). Edge cases as in ``manifest``.
    """
    altered = leaf_hash([changed.get(f, f) for f in fields])
    rows = manifest(docs, fields, id_col, carry={"_altered": altered}, **how)
    rows = rows.select(id_col, "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), fold(F.col("_altered"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
