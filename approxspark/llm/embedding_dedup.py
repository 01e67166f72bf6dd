"""Operator 9: near-duplicate vectors by robust-pruned graphs on overlapping cluster shards.

Vectors of one direction (equal to ``DIGITS`` decimals at length 1) are one node. Nodes go to the shards
of their ``overlap`` nearest centroids (k-means on a bounded sample; a shard above ``SHARD`` nodes is split again
the same way, until none is). In each shard a flat graph is built whose edges are robust-pruned neighbours;
adjacency lists of all shards are united, so that an edge found in one shard also serves the others that
hold both its ends. Every node of a shard is then searched from the shard's medoid: a greedy beam walks to
the node's neighbourhood, and from every vector within range found, the search expands along edges while it
finds more within range. Links are verified in double precision.

Centroids within range of each other are one, so that a dense group stays whole. A shard that can't be split, as
its nodes lie so close together, is dealt to parts by hash, and each two parts are compared whole (for such a group the
work grows with the square of its size, as its links do).

A shard gives no list of its pairs: a node's links are counted in its home, the shard of its nearest
centroid, and of a shard's links only those that join its groups are emitted.

Recall is audited against brute force on a bounded sample of vectors that has enough links, for
vectors of few and of many links apart; below the target, shards are drawn anew with more overlap. The greater
count of a node's links and all groups' links are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .components import components

#: Nodes of a shard at most; centroids of a split at most; sampled nodes that a split's k-means sees.
SHARD, CENTROIDS, SAMPLE = 3000, 64, 4096
#: Candidates of a node for pruning, and width of the beam.
POOL, BEAM = 48, 24
#: Vectors of the audit, at first and at most, and links that it should see.
AUDIT, AUDIT_MOST, AUDIT_LINKS = 256, 4096, 2000
#: A vector of more links than this is audited among those of many.
MANY = 16
#: Drawings of shards at most; recall that a result must have after them.
DRAWINGS, LEAST_RECALL = 4, 0.9
#: Decimals in which directions are told apart; a part of a cell that is as large as this share of it was not split.
DIGITS, UNSPLIT = 12, 0.75


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length 1 in double precision, with 64 bits of the digest of their rounded direction; null if there is none."""
    for b in batches:
        nodes, units = [], []
        for x in b.column(1).to_pylist():
            v = np.array([np.nan if e is None else e for e in x], np.float64) if x else np.empty(0)
            most = np.abs(v).max() if len(v) and np.isfinite(v).all() else 0.0
            if not most:
                nodes.append(None)
                units.append(None)
                continue
            v = v / most + 0.0
            u = (v / np.sqrt(v @ v)).astype("<f8").tobytes()
            units.append(u)
            near = (np.round(v / np.sqrt(v @ v), DIGITS) + 0.0).astype("<f8").tobytes()
            nodes.append(int.from_bytes(hashlib.blake2b(near, digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.int64()), pa.array(units, pa.binary())], ["vec_id", "node", "unit"])


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)


def k_means(x: np.ndarray, k: int, seed: int, turns: int = 6) -> np.ndarray:
    k = min(k, len(x))
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(turns):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, overlap: int) -> np.ndarray:
    """The ``overlap`` nearest centroids of each row, the nearest first."""
    scores = x @ c.T
    n = min(overlap, len(c))
    found = np.argpartition(-scores, n - 1, axis=1)[:, :n] if n < len(c) else np.tile(np.arange(len(c)), (len(x), 1))
    return np.take_along_axis(found, np.argsort(-np.take_along_axis(scores, found, 1), axis=1, kind="stable"), 1)


def _apart(x: np.ndarray, c: np.ndarray, least: float) -> np.ndarray:
    """Centroids none of which is within range of one of more rows: a dense group is not cut, which would part its links."""
    order = np.argsort(-np.bincount(np.argmax(x @ c.T, axis=1), minlength=len(c)), kind="stable")
    kept: list[int] = []
    for j in order.tolist():
        if not kept or (c[kept] @ c[j]).max() < least:
            kept.append(j)
    return c[kept]


def _learner(parts: float, seed: int, least: float):
    """Centroids of a cell from its sampled rows: enough for ``parts`` times its size over SHARD."""

    def learn(drawn: pd.DataFrame) -> pd.DataFrame:
        drawn = drawn.sort_values("_k")
        k = int(min(CENTROIDS, max(2, np.ceil(parts * drawn["n"].iloc[0] / SHARD))))
        x = _matrix(list(drawn["unit"]))
        c = _apart(x, k_means(x, k, seed), least)
        return pd.DataFrame({"cell": [drawn["cell"].iloc[0]], "n": [drawn["n"].iloc[0]], "cents": [c.astype("<f8").tobytes()]})

    return learn


def _splitter(overlap: int):
    return lambda rows, cents: _split(rows, cents, overlap)


def _split(rows: pd.DataFrame, cents: pd.DataFrame, overlap: int) -> pd.DataFrame:
    """Nodes of part of a cell to the nearest of the cell's centroids; the first of a home is the home."""
    columns = ["cell", "was", "node", "copies", "home", "unit"]
    if rows.empty:
        return pd.DataFrame({c: [] for c in columns})
    x, c = _matrix(list(rows["unit"])), _matrix([cents["cents"].iloc[0]]).reshape(-1, len(rows["unit"].iloc[0]) // 8)
    near = _nearest(x, c, overlap)
    turns = near.shape[1]
    cell = np.array([f"{rows['cell'].iloc[0]}.{j}" for j in range(len(c))])[near]
    again = {k: np.repeat(rows[k].to_numpy(), turns) for k in ("node", "copies", "unit")}
    home = np.repeat(rows["home"].to_numpy(bool), turns) & (np.arange(len(rows) * turns) % turns == 0)
    return pd.DataFrame({"cell": cell.ravel(), "was": int(cents["n"].iloc[0]), "home": home, **again})[columns]


SHARD_ROWS = "cell string, was long, node long, copies long, home boolean, unit binary"


def shards(nodes: DataFrame, overlap: int, seed: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Cells (cell, node, copies, home, unit) of at most SHARD nodes, every node in one home and perhaps other cells; and
    blocks (cell, side, node, copies, unit) of cells that can't be split: two parts each, side 0 and 1, or one, side 2.

    Cells are split where they are too large, by centroids learnt from a bounded sample of the cell and
    applied to salted parts of it. At the first split a node goes to ``overlap`` cells, later to two.
    Vectors of different lengths never share a cell.
    """
    done, tight, level = None, None, 0
    rows = nodes.select(F.concat(F.lit("v"), (F.length("unit") / 8).cast("int").cast("string")).alias("cell"), F.lit(None).cast("long").alias("was"), "node", "copies", F.lit(True).alias("home"), "unit")
    while True:
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("was").alias("_was")).where(F.col("n") > SHARD)
        sizes, _ = store(sizes.withColumn("same", F.coalesce(F.col("n") >= UNSPLIT * F.col("_was"), F.lit(False))).drop("_was"), "cells")
        small = rows.join(sizes, "cell", "left_anti").drop("was")
        done = small if done is None else done.unionByName(small)
        # each two parts of a cell that can't be split meet in a block
        parts = F.ceil(2 * F.col("n") / SHARD).cast("int")
        whole = rows.where("home").join(sizes.where("same"), "cell").withColumn("_parts", parts).withColumn("_p", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("_parts")).cast("int"))
        met = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda q: F.struct(
            F.concat_ws("-", F.col("cell"), F.least(q, F.col("_p")).cast("string"), F.greatest(q, F.col("_p")).cast("string")).alias("cell"),
            F.when(q == F.col("_p"), 2).when(q > F.col("_p"), 0).otherwise(1).alias("side")))
        whole = whole.select(F.explode(met).alias("_m"), "node", "copies", "unit").select("_m.*", "node", "copies", "unit")
        tight = whole if tight is None else tight.unionByName(whole)
        if sizes.where("NOT same").isEmpty():
            return done, tight
        over = rows.join(sizes.where("NOT same").drop("same"), "cell").drop("was")
        pick = Window.partitionBy("cell").orderBy(F.xxhash64("node", F.lit(seed)))
        drawn = over.withColumn("_k", F.row_number().over(pick)).where(F.col("_k") <= SAMPLE)

        cents, _ = store(drawn.select("cell", "n", "unit", "_k").groupBy("cell").applyInPandas(_learner(2.0 * overlap if level == 0 else 3.0, seed, least), "cell string, n long, cents binary"), "centroids")
        salts = F.ceil(F.col("n") / SHARD).cast("int")
        salted = over.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(level)), salts).cast("int")).select("cell", "salt", "node", "copies", "home", "unit")
        cents = cents.select("cell", "n", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "cents")
        split = salted.groupBy("cell", "salt").cogroup(cents.groupBy("cell", "salt")).applyInPandas(_splitter(overlap if level == 0 else 2), SHARD_ROWS)
        rows, _ = store(split, "split")
        level += 1


def _pruned(x: np.ndarray, degree: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges of the shard's graph: of each node's nearest POOL, nearest first, one is kept unless
    a kept one is ``alpha`` times nearer to it than the node is."""
    n, pool = len(x), min(POOL, len(x) - 1)
    if pool < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    y = x.astype(np.float32)
    s = y @ y.T
    np.fill_diagonal(s, -2)
    cand = np.argpartition(-s, pool - 1, axis=1)[:, :pool] if pool < n - 1 else np.argsort(-s, axis=1)[:, :pool]
    near = np.take_along_axis(s, cand, 1)
    order = np.argsort(-near, axis=1)
    cand, dist = np.take_along_axis(cand, order, 1), np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(near, order, 1)))
    alive, kept, count = np.ones((n, pool), bool), np.zeros((n, pool), bool), np.zeros(n, int)
    for r in range(pool):
        take = alive[:, r] & (count < degree)
        kept[take, r] = True
        count += take
        if r + 1 < pool and take.any():
            between = np.sqrt(np.maximum(0, 2 - 2 * s[cand[take, r][:, None], cand[take, r + 1 :]]))
            alive[np.flatnonzero(take)[:, None], np.arange(r + 1, pool)] &= alpha * between > dist[take, r + 1 :]
    a, j = np.nonzero(kept)
    return a, cand[a, j]


def _build(shard: pd.DataFrame, degree: int, alpha: float) -> pd.DataFrame:
    nodes = shard["node"].to_numpy()
    a, b = _pruned(_matrix(list(shard["unit"])), degree, alpha)
    lo, hi = np.minimum(nodes[a], nodes[b]), np.maximum(nodes[a], nodes[b])
    return pd.DataFrame({"a": lo, "b": hi}).drop_duplicates()


def _neighbours(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adjacency of undirected edges: where each node's list begins, and the lists."""
    src, dst = np.r_[a, b], np.r_[b, a]
    order = np.argsort(src, kind="stable")
    return np.searchsorted(src[order], np.arange(n + 1)), dst[order]


def _spread(at: np.ndarray, lists: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (q, w) for every neighbour w of v."""
    size = at[v + 1] - at[v]
    where = np.repeat(at[v] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return np.repeat(q, size), lists[where]


def range_search(x: np.ndarray, at: np.ndarray, lists: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (q, v) with cosine >= ``least``, q < v, as the graph search from the medoid finds them.

    All nodes are searched together: a beam of the BEAM best nodes a query, of which the best not yet
    expanded is expanded each turn; then the range expansion over pairs within range.
    """
    n, y = len(x), x.astype(np.float32)
    slack = np.float32(least - 1e-5)
    medoid = int(np.argmax(y @ y.sum(0)))
    most = int(np.diff(at).max()) if n else 0
    padded = np.full((n, most), -1)
    padded[np.repeat(np.arange(n), np.diff(at)), np.arange(len(lists)) - np.repeat(at[:-1], np.diff(at))] = lists
    beam = np.full((n, BEAM), -1)
    beam[:, 0] = medoid
    sims = np.full((n, BEAM), -3, np.float32)
    sims[:, 0] = y @ y[medoid]
    fresh = np.zeros((n, BEAM), bool)
    fresh[:, 0] = True
    active, found_q, found_v = np.arange(n), [], []
    while len(active):
        best = np.argmax(np.where(fresh[active], sims[active], -4), axis=1)
        fresh[active, best] = False
        new = padded[beam[active, best]]
        s = np.where(new >= 0, np.einsum("qd,qrd->qr", y[active], y[new]), np.float32(-3))
        s[(new[:, :, None] == beam[active][:, None, :]).any(2)] = -3
        qi, ri = np.nonzero(s >= slack)
        found_q.append(active[qi])
        found_v.append(new[qi, ri])
        every, sim, is_new = np.concatenate([beam[active], new], 1), np.concatenate([sims[active], s], 1), np.concatenate([fresh[active], s > -3], 1)
        top = np.argpartition(-sim, BEAM - 1, axis=1)[:, :BEAM]
        beam[active], sims[active], fresh[active] = (np.take_along_axis(z, top, 1) for z in (every, sim, is_new))
        beam[sims <= -3] = -1
        fresh &= sims > -3
        active = active[fresh[active].any(1)]
    seen = np.unique(np.r_[np.arange(n) * n + np.arange(n), np.concatenate(found_q) * n + np.concatenate(found_v)]) if n else np.empty(0, np.int64)
    front = seen
    while len(front):
        new = np.empty(0, np.int64)
        for i in range(0, len(front), 100_000):
            q, v = _spread(at, lists, front[i : i + 100_000] // n, front[i : i + 100_000] % n)
            code = np.setdiff1d(np.unique(q * n + v), seen, assume_unique=True)
            near = np.concatenate([np.einsum("pd,pd->p", y[c // n], y[c % n]) >= slack for c in np.split(code, range(200_000, len(code), 200_000))])
            new = np.union1d(new, code[near])
        seen, front = np.union1d(seen, new), new
    q, v = seen // n, seen % n
    q, v = np.minimum(q, v), np.maximum(q, v)
    code = np.unique(q[q < v] * n + v[q < v])
    q, v = code // n, code % n
    exact = np.concatenate([np.einsum("pd,pd->p", x[i], x[j]) >= least for i, j in zip(np.split(q, range(200_000, len(q), 200_000)), np.split(v, range(200_000, len(v), 200_000)))]) if len(q) else np.empty(0, bool)
    return q[exact], v[exact]


def _joining(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links (a, b) among n nodes join groups not yet joined by those before."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    # most links lie within groups that few links join: look only at those whose ends still differ
    rest = np.arange(len(a))
    while len(rest):
        for k in rest[:4096].tolist():
            i, j = find(int(a[k])), find(int(b[k]))
            if i != j:
                root[max(i, j)] = min(i, j)
                kept.append(k)
        rest = rest[4096:]
        if len(rest):
            of = np.array([find(i) for i in range(n)])
            rest = rest[of[a[rest]] != of[b[rest]]]
    return np.array(kept, np.int64)


def _found(nodes: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray, home: np.ndarray) -> pd.DataFrame:
    """Links that join groups (a, b) and how many rows each node of ``home`` is linked with (a, null, others)."""
    others = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
    k = _joining(len(nodes), a, b)
    own = np.flatnonzero(home & (others > 0))
    return pd.DataFrame({
        "a": np.r_[nodes[a[k]], nodes[own]], "b": pd.array(np.r_[nodes[b[k]], np.zeros(len(own), np.int64)], "Int64").copy(),
        "others": np.r_[np.zeros(len(k), np.int64), others[own].astype(np.int64)]}).assign(b=lambda d: d["b"].mask(d["others"] > 0))


FOUND = "a long, b long, others long"


def _search(shard: pd.DataFrame, edges: pd.DataFrame, least: float) -> pd.DataFrame:
    shard = shard.sort_values("node")
    nodes = shard["node"].to_numpy()
    if not len(nodes):
        return pd.DataFrame({"a": [], "b": [], "others": []})
    at, lists = _neighbours(len(nodes), np.searchsorted(nodes, edges["a"].to_numpy()), np.searchsorted(nodes, edges["b"].to_numpy()))
    a, b = range_search(_matrix(list(shard["unit"])), at, lists, least)
    return _found(nodes, shard["copies"].to_numpy(np.float64), a, b, shard["home"].to_numpy(bool))


def _block(block: pd.DataFrame, least: float) -> pd.DataFrame:
    """All links between a block's two parts, or within its one."""
    block = block.sort_values("node")
    x, side = _matrix(list(block["unit"])), block["side"].to_numpy()
    hit = x @ x.T >= least
    hit &= np.triu(side[:, None] != side[None, :], 1) if (side < 2).all() else np.triu(np.ones(len(x), bool), 1)
    a, b = np.nonzero(hit)
    return _found(block["node"].to_numpy(), block["copies"].to_numpy(np.float64), a, b, np.ones(len(x), bool))


def find_links(nodes: DataFrame, least: float, overlap: int, seed: int, degree: int, alpha: float) -> tuple[DataFrame, DataFrame]:
    """What one drawing of shards finds: links (a, b) that join groups, and (node, others), the rows each node is linked with."""
    cells, blocks = shards(nodes, overlap, seed, least)
    cells, _ = store(cells, "shards")
    built = cells.groupBy("cell").applyInPandas(lambda g: _build(g, degree, alpha), "a long, b long").distinct()
    built, _ = store(built, "edges")
    # the united lists, given to each shard that holds both ends of an edge
    end = lambda c: cells.select(F.col("node").alias(c), "cell")
    own, _ = store(built.join(end("a"), "a").join(end("b"), ["b", "cell"]).select("cell", "a", "b"), "own-edges")
    found = cells.groupBy("cell").cogroup(own.groupBy("cell")).applyInPandas(lambda s, e: _search(s, e, least), FOUND)
    found = found.unionByName(blocks.groupBy("cell").applyInPandas(lambda g: _block(g, least), FOUND))
    found, _ = store(found, "found")
    counts = found.where("others > 0").groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    return found.where("b IS NOT NULL").select("a", "b").distinct(), counts


def brute_force(nodes: DataFrame, sample: DataFrame, least: float) -> DataFrame:
    """(node, others): rows within range of each of a bounded sample of nodes (collected, at most AUDIT_MOST)."""
    drawn = sample.collect()
    shared = nodes.sparkSession.sparkContext.broadcast([(r["node"], bytes(r["unit"])) for r in drawn])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(u) for _, u in shared.value}:
            mine = [(k, u) for k, u in shared.value if len(u) == size]
            sides[size] = np.array([k for k, _ in mine]), _matrix([u for _, u in mine])
        total = {k: 0 for k, _ in shared.value}
        for b in batches:
            ids, copies, units = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist()
            for size in {len(u) for u in units} & set(sides):
                at = np.array([i for i, u in enumerate(units) if len(u) == size])
                theirs, y = sides[size]
                hit = (_matrix([units[i] for i in at]) @ y.T >= least) & (ids[at][:, None] != theirs[None, :])
                for k, n in zip(theirs.tolist(), (copies[at][:, None] * hit).sum(0).tolist()):
                    total[k] += int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["node", "others"])

    return nodes.select("node", "copies", "unit").mapInArrow(compare, "node long, others long").groupBy("node").agg(F.sum("others").alias("others"))


def audit(nodes: DataFrame, least: float, seed: int) -> DataFrame:
    """(node, others) of vectors drawn until they have AUDIT_LINKS links, AUDIT_MOST are drawn, or all."""
    size, total = AUDIT, nodes.count()
    while True:
        sample, _ = store(nodes.orderBy(F.xxhash64("node", F.lit(seed))).limit(size).select("node", "unit"), "audit")
        truth, _ = store(brute_force(nodes, sample, least), "truth")
        if size >= min(AUDIT_MOST, total) or (truth.agg(F.sum("others")).first()[0] or 0) >= AUDIT_LINKS:
            return truth
        size = min(AUDIT_MOST, 4 * size)


def recall(truth: DataFrame, counts: DataFrame) -> dict[str, float]:
    """Share of the audited vectors' links that are counted, for vectors of few and of many links apart."""
    both = truth.where("others > 0").join(counts.withColumnRenamed("others", "_got"), "node", "left")
    many = F.when(F.col("others") > MANY, "many").otherwise("few").alias("links")
    rows = both.groupBy(many).agg(F.sum("others").alias("n"), F.sum(F.coalesce("_got", F.lit(0))).alias("got")).collect()
    return {r["links"]: r["got"] / r["n"] for r in rows}


def near_vectors(vectors: DataFrame, least: float = 0.95, overlap: int = 3, target: float = 0.99, degree: int = 16, alpha: float = 1.2, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding", report: dict | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are linked when their cosine in double precision is at least ``least``; null or empty
    vectors, zero ones, and those with null or non-finite components are linked with nothing, nor are
    vectors of different lengths. n_links counts other rows, equal ones included; component_id is the
    smallest id reachable. A row with a null id is never linked: its component is null and it is kept.
    An empty table gives no rows; other columns are not read. Directions that agree to DIGITS decimals count as
    one. ``report`` is filled with the audit: drawings of shards, audited vectors, their links, and the recall of those
    of vectors with few and with many links.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows, _ = store(rows.mapInArrow(_units, "vec_id long, node long, unit binary"), "units")
    nodes, _ = store(rows.where("node IS NOT NULL AND vec_id IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("unit").alias("unit")), "nodes")
    truth = audit(nodes, least, seed)
    links, degrees = None, None
    for turn in range(DRAWINGS):
        found, counts = find_links(nodes.select("node", "copies", "unit"), least, overlap + 2 * turn, seed + turn, degree, alpha)
        links = found if links is None else links.unionByName(found)
        degrees, _ = store(counts if degrees is None else degrees.unionByName(counts).groupBy("node").agg(F.max("others").alias("others")), "counts")
        reached = recall(truth, degrees)
        if min(reached.values(), default=1.0) >= target:
            break
    if min(reached.values(), default=1.0) < LEAST_RECALL:
        raise RuntimeError(f"recall {reached} after {DRAWINGS} drawings of shards")
    if report is not None:
        report.update(drawings=turn + 1, audited=truth.count(), links=truth.agg(F.sum("others")).first()[0] or 0, recall=reached)
    labels = components(links)
    degrees = degrees.withColumnRenamed("node", "a")
    smallest = labels.join(nodes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("component_id"))
    of_node = (nodes.select("node", "rep", "copies").join(degrees, F.col("node") == F.col("a"), "left").join(labels, "node", "left").join(smallest, "label", "left")
               .select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component_id", "rep").alias("component_id")))
    known = F.col("vec_id").isNotNull()
    return rows.select("vec_id", "node").join(of_node, "node", "left").select(
        "vec_id", F.when(known, F.coalesce("n", F.lit(0))).otherwise(0).alias("n_links"), F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
