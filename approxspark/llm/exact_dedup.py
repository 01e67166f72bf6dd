"""Operator 4: exact deduplication by counting quotient filters and byte verification.

A text's 64-bit fingerprint is split into a quotient (its slot, the first bits) and a remainder (the rest). Each input
partition packs its fingerprints into a counting quotient filter, stored as one block per slot
with sorted remainders and their counts; blocks of a slot from all partitions merge without
loss, two sorted runs of remainders at a time, and counts of equal ones add up. Fingerprints with a merged count above one are
routed to byte verification, which groups the texts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store

#: Fingerprints that one block is meant to hold; the number of slot ranges follows the number of rows.
BLOCK = 200_000


def normalised(text: Column) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def _build(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A partition's filter: blocks of sorted remainders with counts, by the fingerprint's first ``bits``."""
    parts = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches]
    if not parts:
        return
    prints, counts = np.unique(np.concatenate(parts), return_counts=True)
    quotient, remainder = prints >> np.uint64(64 - bits), prints & np.uint64((1 << (64 - bits)) - 1)
    cuts = np.flatnonzero(np.diff(quotient)) + 1
    blocks = [(int(q[0]), r.astype("<u8").tobytes(), c.astype("<u4").tobytes()) for q, r, c in zip(np.split(quotient, cuts), np.split(remainder, cuts), np.split(counts, cuts))]
    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*blocks), (pa.int64(), pa.binary(), pa.binary()))], ["slot", "remainders", "counts"])


def merge_runs(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs of distinct remainders with their counts as one."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    at = np.searchsorted(a[0], b[0])
    same = a[0][np.minimum(at, len(a[0]) - 1)] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    counts = a[1].copy()
    counts[at[same]] += b[1][same]
    return np.insert(a[0], at[~same], b[0][~same]), np.insert(counts, at[~same], b[1][~same])


def _merger(bits: int):
    def merge(blocks: pd.DataFrame) -> pd.DataFrame:
        """Merge the blocks of one slot; the fingerprints that occur more than once, with their counts."""
        runs = [(np.frombuffer(r, "<u8"), np.frombuffer(c, "<u4").astype(np.int64)) for r, c in zip(blocks["remainders"], blocks["counts"])]
        while len(runs) > 1:
            runs = [merge_runs(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
        remainders, counts = runs[0]
        many = counts > 1
        slot = np.uint64(int(blocks["slot"].iloc[0])) << np.uint64(64 - bits)
        return pd.DataFrame({"fingerprint": (remainders[many] | slot).view(np.int64), "copies": counts[many]})

    return merge


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (one long column) that occur more than once, through merged counting quotient filters."""
    bits = max(4, int(np.ceil(np.log2(max(1, rows / BLOCK)))) + 2)
    blocks = prints.mapInArrow(lambda it: _build(it, bits), "slot long, remainders binary, counts binary")
    return blocks.groupBy("slot").applyInPandas(_merger(bits), "fingerprint long, copies long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (and row, if ``row_col`` is given).

    Texts are equal when identical after deleting every character of [\\x20\\x09-\\x0D]; of equal texts
    the one with the most code points, then the smallest id, stays (a null id is the last resort).
    Null texts count as empty. Exactly one row of each group is kept, whether ids repeat or are null:
    rows are told apart by a key of their own, stored with them. ``row_col`` names such a key (a long,
    unique and stored) where the caller filters by it. An empty table gives no rows; other columns are
    not read.
    """
    norm = normalised(F.col(text_col))
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows, _ = store(
        docs.select(F.col(id_col).alias("doc_id"), norm.alias("_t"), F.length(F.coalesce(text_col, F.lit(""))).alias("n"), row.alias("row"))
        .select("doc_id", "n", "row", F.xxhash64("_t").alias("fp"), F.sha2("_t", 256).alias("text_sha256")), "copies")
    again, _ = store(repeated_fingerprints(rows.select("fp"), rows.count()).select(F.col("fingerprint").alias("fp")), "repeated")
    # byte verification: the texts behind repeated fingerprints are grouped by their bytes, copies meeting within
    # each task first; the join's key isn't one of the grouping's, so that a hot fingerprint can be split
    classes = (
        docs.select(norm.alias("_t")).withColumn("fp", F.xxhash64("_t")).join(again, "fp", "left_semi")
        .groupBy("_t").agg(F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1").select(F.sha2("_t", 256).alias("text_sha256"), "group_size")
    )
    # one class a digest: were two texts to share one, say so rather than merge them
    classes = classes.groupBy("text_sha256").agg(F.first("group_size").alias("group_size"), F.count(F.lit(1)).alias("_texts"))
    classes = classes.withColumn("group_size", F.when(F.col("_texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")))
    # the row that stays, by the stored keys
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    stays = rows.join(again, "fp", "left_semi").groupBy("text_sha256").agg(best).select("text_sha256", F.col("best.doc_id").alias("_id"), F.col("best.row").alias("_row"))
    classes = classes.select("text_sha256", "group_size").join(stays, "text_sha256")
    alone = F.col("group_size").isNull()
    return rows.join(classes, "text_sha256", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("_row"))).alias("kept"), "text_sha256", *(["row"] if row_col else []))
