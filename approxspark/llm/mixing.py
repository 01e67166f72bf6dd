"""Operator 2: mix overlapping sources to target weights by a min-cost flow over membership patterns.

Documents are aggregated by membership pattern (the set of sources that they belong to); the flow
routes each pattern's words to its sources' quotas, where reading a pattern the k-th time costs k-1
a word (convex repetition costs). The network has one node for each pattern and source, never for a
document. Each pattern's flow is then met by documents in a seeded order: all of them for each whole
pass, and the first of the order for what remains, the last one in part or, with ``whole``, only
whole ones, chosen among those next to the order's end so that their sum is nearest to what remains.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

WORD = r"[^\x20\x09-\x0D]+"
#: Documents on each side of a last pass's end among which whole ones are chosen.
NEXT = 8
#: Share of its last pass's words by which a pattern may miss them further for the sum over all patterns.
SLACK = 0.01


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_shares(total: float, sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """``total`` shared by weight, each share at most ``most`` times its size and the excess reshared.

    The result is min(most * size, level * weight) for the one level at which the shares add up.
    """
    caps = [float(most * s) for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i])
    capped, open_weight = 0.0, float(sum(weights))
    for i in order:
        level = (total - capped) / open_weight
        if caps[i] >= level * weights[i]:
            return [min(c, level * w) for c, w in zip(caps, weights)]
        capped += caps[i]
        open_weight -= weights[i]
    return caps


def route(capacity: dict[tuple, int], quota: dict[str, int], passes: int) -> dict[tuple[tuple, str], int]:
    """Min-cost flow from patterns to sources by successive shortest paths.

    ``capacity``: words of each pattern (a tuple of sources); the k-th pass over a pattern costs k-1
    a word. As costs arise at the patterns alone, paths are sought pass by pass, cheapest first.
    """
    flow: dict[tuple[tuple, str], int] = {}
    need = dict(quota)
    used = dict.fromkeys(capacity, 0)
    for k in range(1, passes + 1):
        for start in sorted(capacity, key=len):
            while (room := k * capacity[start] - used[start]) > 0:
                # breadth first from this pattern over sources, and back over flow that can move elsewhere
                none = object()  # None is the null source
                back: dict = {start: none}
                queue, end = deque([start]), none
                while queue and end is none:
                    p = queue.popleft()
                    for s in p:
                        if s in back:
                            continue
                        back[s] = p
                        if need.get(s, 0) > 0:
                            end = s
                            break
                        for q in capacity:
                            if q not in back and flow.get((q, s), 0) > 0:
                                back[q] = s
                                queue.append(q)
                if end is none:
                    break
                path, at = [], end
                while at is not none:
                    path.append(at)
                    at = back[at]
                path.reverse()  # pattern, source, pattern, source ...
                amount = min([room, need[end], *(flow[path[i + 1], path[i]] for i in range(1, len(path) - 1, 2))])
                for i in range(0, len(path) - 1, 2):
                    flow[path[i], path[i + 1]] = flow.get((path[i], path[i + 1]), 0) + amount
                    if i:
                        flow[path[i], path[i - 1]] -= amount
                need[end] -= amount
                used[start] += amount
    return {k: v for k, v in flow.items() if v}


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source: str | Column = "source", keep: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """One row per document: doc_id, sources, size, source_size, target, taken (words taken, repeats counted).

    ``source`` is a string column, or an array of the sources that a document belongs to (an
    element, or the whole, may be null: the null source). Sources in code point order, null last,
    weigh ``weights`` in turn and share ``share`` times all words; a target stops at ``most`` times
    its source's words. source_size and target are those of the document's first source. The number
    of patterns, not that of documents, is what the driver sees: the flow is meant for up to some thousands of
    them (corpora, crawls, licences), not for sources such as hosts, which have to be grouped first. Null or empty texts have size 0
    and take 0; repeated rows are documents of their own; an empty table gives no rows; of further
    columns only ``keep`` is read and returned. The document at which a pattern's last pass ends is taken
    in part. With ``whole`` taken is a multiple of size: of the ``NEXT`` documents on each side of the pass's
    end those are taken whose words come nearest to what remains. A pattern misses its words by half the
    document at the end at most, and by few where it has documents of several sizes.
    """
    spark = docs.sparkSession
    col = F.col(source) if isinstance(source, str) else source
    kind = docs.select(col).schema[0].dataType.typeName()
    member = F.coalesce(F.array_sort(F.array_distinct(col)), F.array(F.lit(None).cast("string"))) if kind == "array" else F.array(col.cast("string"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    rows, _ = store(docs.select(F.col(id_col).alias("doc_id"), member.alias("sources"), word_count(F.col(text_col)).alias("size"), order.alias("_h"), F.monotonically_increasing_id().alias("_row"), *keep), "mix")
    bucket = F.substring("_h", 1, 3)
    sums = [(tuple(r["sources"]), r["size"]) for r in rows.groupBy("sources").agg(F.sum("size").alias("size")).collect()]
    if not sums:
        return rows.select("doc_id", "sources", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("taken"), *keep)
    sums.sort(key=lambda x: str(x[0]))
    sizes: dict = {}
    for p, n in sums:
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in sizes)
    capacity = dict(sums)
    weigh = [float(weights[i % len(weights)]) for i in range(len(names))]
    targets = dict(zip(names, capped_shares(share * sum(capacity.values()), [sizes[s] for s in names], weigh, most)))
    flows = route(capacity, {s: int(t) for s, t in targets.items()}, most)
    words = {p: sum(v for (q, _), v in flows.items() if q == p) for p in capacity}
    plan = spark.createDataFrame(
        [(list(p), capacity[p], sizes[p[0]], targets[p[0]], words[p] // max(1, capacity[p]), words[p] % max(1, capacity[p])) for p in capacity],
        "sources array<string>, _capacity long, source_size long, target double, _passes long, _rest long",
    )
    # arrays with nulls don't compare equal in a join: the key is text in which a null has a form of its own
    key = lambda: F.to_json(F.transform("sources", lambda s: F.struct(s.alias("s"))))
    # where in the seeded order each pattern's last, partial pass ends: sums by the order's first 12 bits
    steps = rows.groupBy(key().alias("_p"), bucket.alias("_b")).agg(F.sum("size").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    plan = plan.select(key().alias("_p"), "source_size", "target", "_passes", "_rest")
    edge = (steps.withColumn("_to", upto).join(plan, "_p").where((F.col("_to") > F.col("_rest")) & (F.col("_to") - F.col("_n") <= F.col("_rest")))
            .groupBy("_p").agg(F.min(F.struct("_b", (F.col("_rest") - F.col("_to") + F.col("_n")).alias("left"))).alias("_e")))
    plan, _ = store(plan.join(edge, "_p", "left").select("_p", "source_size", "target", "_passes", "_rest", F.col("_e._b").alias("_edge"), F.coalesce("_e.left", F.lit(0)).alias("_left")).coalesce(1), "mixplan")
    tagged = rows.withColumn("_p", key()).join(plan, "_p").withColumn("_b", bucket)
    out = lambda df, part: df.select("doc_id", "sources", "size", "source_size", "target", (F.col("size") * F.col("_passes") + part).alias("taken"), *keep)
    inside = F.when(F.col("_b") < F.col("_edge"), F.col("size")).otherwise(F.lit(0))
    w = Window.partitionBy("_p").orderBy("_h", "doc_id", "size", "_row").rowsBetween(Window.unboundedPreceding, 0)
    here = F.col("_b").eqNullSafe(F.col("_edge"))
    upto = F.sum("size").over(w)
    if not whole:
        part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - (upto - F.col("size"))))
        return out(tagged.where(~here), inside).unionByName(out(tagged.where(here), part))
    part = F.when(upto <= F.col("_left"), F.col("size")).otherwise(F.lit(0))
    narrow = tagged.select("_row", "_p", "size", "_h", "doc_id", "_b", "_edge", "_left")
    cols = lambda d, p: d.select("_row", "_p", "size", "_h", F.coalesce(p, F.lit(0)).alias("_part"))
    parts, _ = store(cols(narrow.where(~here), inside).unionByName(cols(narrow.where(here), part)), "mixparts")
    fills = _settle(parts, plan)
    tagged = tagged.join(spark.createDataFrame(fills, "_row long, _fill long"), "_row", "left")
    fill = F.coalesce("_fill", F.lit(0))
    return out(tagged.where(~here), inside + fill).unionByName(out(tagged.where(here), part + fill))


def _settle(parts: DataFrame, plan: DataFrame) -> list[tuple[int, int]]:
    """(row, words more or less) of the documents next to the end of each pattern's last pass that enter or leave
    it: of all choices among them one that brings the pattern nearest to its words, or farther by at most
    ``SLACK`` of them where that brings the sum over all patterns nearer."""
    used = parts.groupBy("_p").agg(F.sum("_part").alias("n"))
    gaps = {r["_p"]: (r["gap"], r["_rest"]) for r in used.join(plan, "_p").select("_p", "_rest", (F.col("_rest") - F.col("n")).alias("gap")).where("gap > 0").collect()}
    if not gaps:
        return []
    side = F.when(F.col("_part") > 0, 1).otherwise(0)
    near = []
    for inside, order in ((1, [F.desc("_h"), F.desc("size"), F.desc("_row")]), (0, ["_h", "size", "_row"])):
        w = Window.partitionBy("_p").orderBy(*order)
        near.append(parts.where((F.col("size") > 0) & (side == inside)).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= NEXT).select("_p", "_row", (F.col("size") * (1 - 2 * inside)).alias("change"), "_k"))
    by: dict = {}
    for r in near[0].unionByName(near[1]).orderBy("_p", "_k", "change").collect():  # 2 * NEXT rows a pattern at most
        by.setdefault(r["_p"], []).append((r["_row"], r["change"]))

    def choices(p: str) -> np.ndarray:
        """How many words each choice (in the order of its bits) is above the pattern's words."""
        sums = np.full(1, -gaps[p][0], np.int64)
        for _, change in by.get(p, []):
            sums = np.r_[sums, sums + change]
        return sums

    least = {p: int(np.abs(choices(p)).min()) for p in gaps}
    out: list[tuple[int, int]] = []
    over = 0
    for p in sorted(gaps, key=lambda p: (-least[p], p)):
        sums = choices(p)
        far = np.abs(sums) > least[p] + SLACK * gaps[p][1]
        choice = int(np.argmin(np.where(far, np.iinfo(np.int64).max, np.abs(sums + over))))
        over += int(sums[choice])
        out += [x for i, x in enumerate(by.get(p, [])) if choice >> i & 1]
    return out
