"""Operator 1: MinHash near-duplicate groups by tensored banding.

Two small collections of ``m`` half keys, each of ``r`` minhashes, are drawn; table (i, j) of the
m * m tables is keyed by the pair (left half i, right half j). So 2 * m * r minhashes make m * m
tables of 2 * r minhashes each, where plain banding would need m * m * 2 * r. Two sets of similarity J
meet in some table with probability (1 - (1 - J^r)^m)^2: 0.997 at 0.75 and above 0.9995 at 0.8 for
r = 3, m = 12.

Candidates are verified on full sets, in two steps, and neither emits the pairs of a table key. First
each member of the tables (i, i) is compared with its key's first member; groups so found are merged.
Then, for every left half key whose members still lie in several groups (it holds the keys of m
tables, so nothing that any table would pair is passed over), the members outside its largest group are
compared with all its members. That is done in blocks of about ``BLOCK`` by ``BLOCK`` members, whose
intersections are one matrix product; a hot key becomes many blocks, and a block emits only the links that
join its groups. Equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .components import components
from .shingles import Sets, forget, mixed, set_id, shingle_set

#: Shingles hashed at a time.
TOGETHER = 500_000
#: Members on either side of a block; shingles of a block multiplied at a time.
BLOCK, SLICE = 192, 8192


def _functions(m: int, r: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**64, 2 * m * r, dtype=np.uint64), rng.integers(0, 2**64, 2 * m * r, dtype=np.uint64) | np.uint64(1)


def half_keys(sets: list[np.ndarray], m: int, r: int, seed: int) -> np.ndarray:
    """Half keys of non-empty sets: one row a set, left 0..m-1 and right m..2m-1; each knows its place."""
    x = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = np.tile(np.arange(1, 2 * m + 1, dtype=np.uint64), (len(sets), 1))
    for i, (flip, odd) in enumerate(zip(*_functions(m, r, seed))):
        least = np.minimum.reduceat((x ^ flip) * odd, starts)
        j = i // r
        keys[:, j] = mixed(keys[:, j] * np.uint64(0x9E3779B97F4A7C15) + least)
    return keys


def _sketch(batches: Iterator[pa.RecordBatch], width: int, m: int, r: int, seed: int) -> Iterator[pa.RecordBatch]:
    def made(ids: list, keys: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        halves: list = [None] * len(sets)
        if full:
            for i, k in zip(full, half_keys([sets[i] for i in full], m, r, seed).view(np.int64)):
                halves[i] = k
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()),
             pa.array([None if k is None else k[:m] for k in halves], pa.list_(pa.int64())), pa.array([None if k is None else k[m:] for k in halves], pa.list_(pa.int64()))],
            ["doc_id", "row", "n_shingles", "node", "left", "right"])

    for b in batches:
        ids, keys, sets, held = [], [], [], 0
        for doc, text, row in zip(b.column(0), b.column(1), b.column(2)):
            ids.append(doc.as_py())
            keys.append(row.as_py())
            sets.append(shingle_set(text.as_py(), width))
            held += len(sets[-1])
            if held > TOGETHER:
                yield made(ids, keys, sets)
                ids, keys, sets, held = [], [], [], 0
        if ids:
            yield made(ids, keys, sets)
    forget()


def _verify(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    members = Sets(width).of
    for batch in batches:
        out = []
        for a, b, ta, tb in zip(*(batch.column(i) for i in range(4))):
            a, b = a.as_py(), b.as_py()
            x, y = members(a, ta.as_py()), members(b, tb.as_py())
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                out.append((a, b))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
    forget()


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    if len(left) * len(right) <= 32:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)
    rows = [[(i, np.searchsorted(shared, x[np.isin(x, shared, assume_unique=True)])) for i, x in enumerate(side)] for side in (left, right)]
    for at in range(0, len(shared), SLICE):
        a, b = (np.zeros((len(side), min(SLICE, len(shared) - at)), np.float32) for side in (left, right))
        for m, side in ((a, rows[0]), (b, rows[1])):
            for i, where in side:
                lo, hi = np.searchsorted(where, [at, at + SLICE])
                m[i, where[lo:hi] - at] = 1
        out += a @ b.T
    return np.rint(out).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links that join the groups of each block's two sides; a partition's rows are sorted by block (l, bo, bm)."""
    members = Sets(width).of

    def links(block: list) -> list[tuple[int, int]]:
        sides = [[(n, g, members(n, t)) for o, n, g, t in block if o is side] for side in (True, False)]
        if not sides[0] or not sides[1]:
            return []
        both = _common([s for _, _, s in sides[0]], [s for _, _, s in sides[1]])
        size = [np.array([len(s) for _, _, s in side]) for side in sides]
        group = [np.array([g for _, g, _ in side]) for side in sides]
        hit = (both > 0) & (100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)) & (group[0][:, None] != group[1][None, :])
        # of a block's links those that join groups not yet joined within it: the others link nothing more
        root: dict[int, int] = {}

        def find(g: int) -> int:
            while root.get(g, g) != g:
                g = root[g]
            return g

        found = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(hit))):
            (a, ga, _), (b, gb, _) = sides[0][i], sides[1][j]
            ga, gb = find(ga), find(gb)
            if ga != gb:
                root[max(ga, gb)] = min(ga, gb)
                found.append((min(a, b), max(a, b)))
        return found

    def batch(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 2, ["a", "b"])

    key, block = None, []
    for b in batches:
        found = []
        for k, row in zip(zip(*(b.column(i).to_pylist() for i in range(3))), zip(*(b.column(i).to_pylist() for i in range(3, 7)))):
            if k != key:
                found += links(block)
                key, block = k, []
            block.append(row)
        if found:
            yield batch(found)
    yield batch(links(block))
    forget()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, m: int = 12, r: int = 3, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
                    row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles; component_id is the smallest id reachable over links. A null or empty text, or one
    without words, has the empty set and is linked with nothing. A document whose id is null is never
    linked: its component is null and it is kept. Rows that repeat an id are documents of their own
    (equal texts link them). An empty table gives no rows; other columns are not read.

    kept is doc_id = component_id, so that near copies under one id are kept together. With ``row_col`` (a long, unique
    and stored key of the rows, returned as row) exactly one row of each component is kept instead: of those with the
    component's id the one of the least key.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row"))
    schema = "doc_id long, row long, n_shingles long, node long, left array<long>, right array<long>"
    sketches, _ = store(docs.mapInArrow(lambda it: _sketch(it, width, m, r, seed), schema), "sketches")
    nodes, _ = store(
        sketches.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right")), "nodes")

    def near(n, pn):
        return 100 * F.least(n, pn) >= percent * F.greatest(n, pn)

    # first step: members of the tables (i, i) against their key's first member
    zipped = F.explode(F.arrays_zip(F.col("left").alias("l"), F.col("right").alias("r"))).alias("z")
    keys = nodes.select("node", "n", zipped).select(F.xxhash64("z.l", "z.r").alias("key"), "node", "n")
    first = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1").select("key", F.col("p.node").alias("p"), F.col("p.n").alias("pn"))
    pairs = keys.join(first, "key").where((F.col("node") != F.col("p")) & near(F.col("n"), F.col("pn"))).select(F.col("p").alias("a"), F.col("node").alias("b")).distinct()
    pairs, _ = store(pairs, "pairs")

    # texts of all nodes that a left half key brings together: what either step compares
    left = nodes.select("node", F.explode("left").alias("l"))
    shared, _ = store(left.join(left.groupBy("l").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("l"), "l", "left_semi"), "left-halves")
    texts = nodes.select("node", "rep").join(shared.select("node").distinct(), "node", "left_semi")
    texts, _ = store(docs.join(texts, docs.doc_id == texts.rep).select("node", "text"), "texts")
    ta, tb = texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    verified = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb").mapInArrow(lambda it: _verify(it, width, percent), "a long, b long")
    links, _ = store(verified, "links")

    # second step: left half keys whose members lie in several groups; members outside the largest against all
    tagged = shared.join(components(links), "node", "left").select("l", "node", F.coalesce("label", "node").alias("g"))
    groups = tagged.groupBy("l", "g").agg(F.count(F.lit(1)).alias("c")).groupBy("l").agg(F.count(F.lit(1)).alias("groups"), F.sum("c").alias("m"), F.max(F.struct("c", "g")).alias("most"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    spans = groups.where("groups > 1").select("l", F.col("most.g").alias("most"), blocks(F.col("m")).alias("nm"), blocks(F.col("m") - F.col("most.c")).alias("no"))
    rows, _ = store(tagged.join(spans, "l"), "spans")
    deal = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    outside = rows.where("g <> most").select("l", deal(F.col("no")).alias("bo"), F.explode(F.sequence(F.lit(0), F.col("nm") - 1)).alias("bm"), F.lit(True).alias("o"), "node", "g")
    every = rows.select("l", F.explode(F.sequence(F.lit(0), F.col("no") - 1)).alias("bo"), deal(F.col("nm")).alias("bm"), F.lit(False).alias("o"), "node", "g")
    dealt = outside.unionByName(every).join(texts, "node").select("l", "bo", "bm", "o", "node", "g", "text")
    dealt = dealt.repartition("l", "bo", "bm").sortWithinPartitions("l", "bo", "bm")
    more = dealt.mapInArrow(lambda it: _blocks(it, width, percent), "a long, b long").distinct()
    labels = components(links.unionByName(store(more, "links")[0]))

    least = labels.join(nodes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("component_id"))
    of_node = nodes.select("node", "rep").join(labels, "node", "left").join(least, "label", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    found = sketches.select("doc_id", "row", "n_shingles", "node").join(of_node, "node", "left").select("doc_id", "row", "n_shingles", component.alias("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    if not row_col:
        return found.drop("row").withColumn("kept", kept)
    first = found.where(kept & F.col("doc_id").isNotNull()).groupBy("component_id").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("_first"))
    return found.join(first, "row", "left").withColumn("kept", F.col("doc_id").isNull() | F.coalesce("_first", F.lit(False))).drop("_first")
