"""Operator 3: sum-of-squares online packing of tokenised documents into fixed windows.

Each input partition is packed on its own as its documents come, so nothing is shuffled and a lost
executor's partition is packed again with the same result. Whole windows are cut off a long document
first; its rest goes to the fill level that makes the sum over levels of (open windows at that
level) squared smallest, which keeps complementary levels in stock. At the end of a partition the
open windows are merged by cutting the pieces of the emptiest ones, so that at most one window of a
partition is not full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import encode_column, tokenizer_path

#: Bytes of ids handed back to Spark at a time.
OUT_BYTES = 4_000_000


class Packer:
    """Open windows by fill level; a window is a list of pieces [doc row, start, ids]."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.count = np.zeros(size + 1, dtype=np.int64)  # the level array: open windows of each fill
        self.open: list[list[list]] = [[] for _ in range(size + 1)]

    def place(self, piece: list) -> list | None:
        """Put a piece shorter than a window where the sum of squares grows least; the window if that fills it."""
        n, c, size = len(piece[2]) // 4, self.count, self.size
        after = 2 * c[n:] + 1  # growth at the level that the window reaches ...
        after[-1] = 0  # ... none if it is then full
        before = 2 * c[: size - n + 1] - 1  # fall at the level that it leaves
        before[0] = 0
        cost = np.where(c[: size - n + 1] > 0, after - before, np.iinfo(np.int64).max)
        cost[0] = after[0]  # a new window
        level = size - n - int(np.argmin(cost[::-1]))  # the fullest of equals
        window = []
        if level:
            window = self.open[level].pop()
            c[level] -= 1
        window.append(piece)
        if level + n == size:
            return window
        self.open[level + n].append(window)
        c[level + n] += 1
        return None

    def flush(self) -> Iterator[list]:
        """Close all windows: the emptiest are cut up to fill the fullest."""
        left = [(level, w) for level in range(1, self.size) for w in self.open[level]]
        lo, hi = 0, len(left) - 1
        while lo <= hi:
            level, window = left[hi]
            while lo < hi and level < self.size:
                has, donor = left[lo]
                doc, start, ids = donor.pop()
                n = min(self.size - level, len(ids) // 4)
                cut = len(ids) - 4 * n
                window.append([doc, start + cut // 4, ids[cut:]])
                if cut:
                    donor.append([doc, start, ids[:cut]])
                level += n
                left[lo] = (has - n, donor)
                lo += not donor
            yield window
            hi -= 1


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    packer, end, out, held, seq = Packer(size), np.array([end_id], "<u4").tobytes(), [], 0, 0

    def close(window: list) -> None:
        nonlocal held, seq
        at = 0
        for (doc, total), start, ids in window:
            out.append((doc, start, len(ids) // 4, ids, total, base + seq, at))
            at += len(ids) // 4
            held += len(ids)
        seq += 1

    def batch() -> pa.RecordBatch:
        nonlocal held
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        out.clear()
        held = 0
        return made

    for b in batches:
        for doc, ids in zip(b.column(0).to_pylist(), encode_column(b.column(1), path)):
            ids += end
            n = len(ids) // 4
            for start in range(0, n - n % size, size):
                close([[(doc, n), start, ids[4 * start : 4 * (start + size)]]])
                if held > OUT_BYTES:
                    yield batch()
            if n % size:
                full = packer.place([(doc, n), n - n % size, ids[4 * (n - n % size) :]])
                if full:
                    close(full)
            if held > OUT_BYTES:
                yield batch()
    for window in packer.flush():
        close(window)
        if held > OUT_BYTES:
            yield batch()
    if out:
        yield batch()


def pack(docs: DataFrame, size: int = 1024, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` ids.

    Columns: doc_id, start and length (the piece within its document's ids), ids (little-endian
    unsigned 32-bit), doc_tokens (of the document, with the end id), sequence_id, offset (of the
    piece in its sequence, gapless from 0). A null or empty text is a document of the end id alone;
    a null id stays null; repeated rows are packed each; an empty table gives no rows; other columns
    are not read.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    schema = T.StructType([T.StructField(c, T.BinaryType() if c == "ids" else T.LongType()) for c in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _pack(it, path, end_id, size), schema)
