"""Operator 12: ranked lexical search by accumulator-limited, term-at-a-time evaluation.

Queries are taken in blocks of bounded size. For a block, one pass over the texts counts the terms
that the block asks for; these postings are written, and from them follow the document frequencies
and each term's weight. Each task then evaluates the block's queries over its share of the postings,
chunk by chunk: a query's terms are processed rarest first, each adding to the accumulators (partial
scores) of its documents. Once the most that the remaining terms can add is below the k-th largest
partial score, a document without an accumulator can't reach the best k: no more are created, and the
remaining terms only update those that exist. A query's k-th best score of earlier chunks counts too.
The tasks' best k of each query meet in two steps, so that no task holds all of a query's candidates.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

#: Bytes of query texts in a block: a bound on what tasks are sent (a single longer query makes its own block).
BLOCK_BYTES = 8_000_000
#: Postings that a task evaluates at a time.
CHUNK = 2_000_000
#: Groups in which a query's candidates meet first.
SPLIT = 64

#: Bytes of a term as they are (A-Z in lower case); all others part terms.
_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERMS).split() if text else []


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """A row per document with a term: doc_id, its length and, of the asked terms, their numbers and counts."""
    known = vocabulary.keys()
    for b in batches:
        out = []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
            found = terms(text.as_py())
            if found:
                counts = Counter(found)
                asked = counts.keys() & known if len(counts) < len(known) else known & counts.keys()
                out.append((doc, len(found), [vocabulary[t] for t in asked], [counts[t] for t in asked]))
        if out:
            doc, n, term, tf = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tfs"])


class Best:
    """The k best documents of a query so far: highest score, then smallest id (null ids last)."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.doc, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """The score that a document must at least have; 1 while there are fewer than k."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.r_[self.score, score], np.r_[self.doc, doc], np.r_[self.null, null]
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]], rows: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the best k, and their scores, all exact.

    ``lists`` holds, rarest term first, each term's documents (ascending) and what the term adds to their scores;
    ``least`` is a score that the k-th best is known to reach.
    """
    tops = [int(gain.max(initial=0)) for _, gain in lists]
    remaining = list(itertools.accumulate(reversed(tops), initial=0))[::-1]  # [i]: the most that terms i, i + 1, ... add
    acc = np.zeros(rows, np.int64)
    held = np.zeros(rows, bool)
    at = 0
    for doc, gain in lists:
        acc[doc] += gain
        held[doc] = True
        at += 1
        if remaining[at] < least:
            break
        if at < len(lists) and remaining[at] < acc.max(initial=0):
            kth = np.partition(acc, rows - k)[rows - k] if rows >= k else 0
            least = max(least, int(kth))
            if remaining[at] < least:
                break
    # no more accumulators: the survivors take what the remaining terms add
    survivors = np.flatnonzero(held)
    for doc, gain in lists[at:]:
        if 16 * len(survivors) < len(doc):
            i = np.minimum(np.searchsorted(doc, survivors), len(doc) - 1)
            acc[survivors] += np.where(doc[i] == survivors, gain[i], 0)
        else:
            acc[doc] += np.where(held[doc], gain, 0)
    score = acc[survivors]
    enough = score >= max(least, 1)
    return survivors[enough], score[enough]


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        at = 0
        ends = b.column(2).offsets.to_numpy()
        ends = ends - ends[0]
        while at < len(b):
            # as many documents as fit, one at least
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + size - n, side="right")) - 1)
            held.append(b.slice(at, to - at))
            n += int(ends[to] - ends[at])
            at = to
            if n >= size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _search(
    batches: Iterator[pa.RecordBatch], queries: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int
) -> Iterator[pa.RecordBatch]:
    """The best k of each query among a task's documents: query, score, doc_id."""
    best = [Best(k) for _ in queries]
    for table in _chunks(batches, CHUNK):
        doc = table.column(0).combine_chunks()
        null = np.asarray(doc.is_null().to_numpy(zero_copy_only=False))
        doc = doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        n = table.column(1).to_numpy().astype(np.int64)
        lists = table.column(2).combine_chunks()
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = table.column(3).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(doc)), np.diff(lists.offsets.to_numpy()))
        norm = 100 - 50 + (50 * n * documents) // max(length, 1)
        gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[row]))
        order = np.argsort(term, kind="stable")  # rows stay ascending within a term
        row, gain = row[order], gain[order]
        cuts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        for asked, top in zip(queries, best):
            found = [(row[cuts[t] : cuts[t + 1]], gain[cuts[t] : cuts[t + 1]]) for t in asked if cuts[t] < cuts[t + 1]]
            if found:
                at, score = accumulate(found, len(doc), k, top.least)
                if len(at):
                    top.add(score, doc[at], null[at])
    query = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
    if len(query):
        score, found, null = (np.concatenate([getattr(b, c) for b in best]) for c in ("score", "doc", "null"))
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(score, pa.int64()), pa.array(found, pa.int64(), mask=null)], ["_query", "score", "doc_id"])


def _query_blocks(items: DataFrame, size: int) -> Iterator[list[tuple]]:
    """Queries (number, id, text) in blocks of bounded bytes, streamed to the driver one partition at a time."""
    block, held = [], 0
    for r in items.toLocalIterator():
        if block and held + len(r["_text"]) > size:
            yield block
            block, held = [], 0
        block.append((r["_item"], bytes(r["_text"])))
        held += len(r["_text"])
    if block:
        yield block


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item, scores above 0 only: item, rank, doc_id, score.

    Every text is read whole. Each row of ``items`` is a query of its own: two rows of one item id give two
    rankings, a null item id is an id; its terms count once each. Null or empty texts and texts without a term
    give no rows, as queries and as documents. Documents are rows: of equal scores the smallest id comes first, a
    null id last; a repeated id is ranked as often as it occurs. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    asked = items.select(F.struct(F.col(item_col).alias("id"), F.monotonically_increasing_id().alias("row")).alias("_item"), F.col(query_col).cast("binary").alias("_text"))
    asked, _ = store(asked.where(F.octet_length("_text") > 0), "queries")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    id_type = items.schema[item_col].dataType
    schema = f"{item_col} {id_type.simpleString()}, _row long, rank int, doc_id long, score long"
    found = []
    for block in _query_blocks(asked, block_bytes):
        queries = [list(dict.fromkeys(terms(text))) for _, text in block]
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(itertools.chain.from_iterable(queries)))}
        postings, _ = store(texts.mapInArrow(lambda it, v=vocabulary: _postings(it, v), "doc_id long, n long, terms array<int>, tfs array<long>"), "postings")
        total = postings.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        documents, length = total["documents"], total["length"]
        # one row for each term of the block's queries
        frequency = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator())
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        numbered = [np.array(sorted((vocabulary[t] for t in q if vocabulary[t] in frequency), key=lambda t: (frequency[t], t)), np.int64) for q in queries]
        hits = postings.mapInArrow(
            lambda it, q=numbered, w=weights, d=documents, n=length: _search(it, q, w, d, n, k), "_query long, score long, doc_id long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        part = F.pmod(F.spark_partition_id(), F.lit(SPLIT))
        first = Window.partitionBy("_query", "_part").orderBy(*order)
        hits = hits.withColumn("_part", part).withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k)
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("_query").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, *item) for i, (item, _) in enumerate(block)], f"_query long, {item_col} {id_type.simpleString()}, _row long")
        hits, _ = store(hits.join(names, "_query").select(item_col, "_row", "rank", "doc_id", "score"), "hits")
        found.append(hits)
    result = spark.createDataFrame([], schema)
    for hits in found:
        result = result.unionByName(hits)
    return result.drop("_row")
