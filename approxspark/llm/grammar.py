"""Operator 10: token ids on disk, compressed by Re-Pair grammars that allow random access.

Documents in ascending order of id are cut into blocks of whole documents. In each block frequent
pairs of adjacent symbols are replaced by nonterminals, over and over; a block stores its rules with
their expansion lengths, the remaining symbols, and its documents' ids and lengths. Blocks are rows
of a Parquet table (part, block, n_ids, data); ``data`` is, little-endian:

    4s magic "RPG1" | u32 symbol width in bytes (2 or 4) | u32 first nonterminal |
    u32 documents | u32 rules | u64 symbols | u64 ids |
    i64 document ids | u1 document id is null | u32 document lengths |
    u32 pairs of symbols, a rule each | u32 expansion lengths of the rules | symbols
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .tokens import encode_column, tokenizer_path

HEAD = struct.Struct("<4sIIIIQQ")
#: Ids of a block, unless a document alone has more.
BLOCK = 1_000_000


#: Slots in which pairs are looked up (a power of two).
SLOTS = 1 << 18


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)).view(np.int64)


def compress(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, rules, first nonterminal): all pairs seen ``least`` times (2 at least) are replaced, until there is none."""
    seq = ids.astype(np.int32)
    first = int(seq.max()) + 1 if len(seq) else 0
    rules = np.empty((0, 2), np.int64)
    while len(seq) > 1:
        code = (seq[:-1].astype(np.int64) << 32) | seq[1:]
        slot = _slot(code)
        # only pairs whose slot is met so often can be frequent
        at = np.flatnonzero((np.bincount(slot, minlength=SLOTS) >= least)[slot])
        if not len(at):
            break
        code, slot = code[at], slot[at]
        ordered = np.sort(code)
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.diff(np.r_[starts, len(ordered)])
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        chosen = ordered[starts[often]]
        # looked up by hash; of two pairs in one slot the other's turn comes in the next round
        slots = np.zeros(SLOTS, np.int32)
        slots[_slot(chosen)] = np.arange(len(chosen))
        k = slots[slot]
        hit = chosen[k] == code
        at, k = at[hit], k[hit]
        # overlapping hits: of a run of neighbours every other one, from its first
        run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
        take = (np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0
        at, k = at[take], k[take]
        used, k = np.unique(k, return_inverse=True)
        seq[at] = first + len(rules) + k
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules = np.concatenate([rules, np.stack([chosen[used] >> 32, chosen[used] & 0xFFFFFFFF], axis=1)])
    return seq, rules, first


def lengths_of(rules: np.ndarray, first: int) -> np.ndarray:
    out: list[int] = []
    size = lambda s: 1 if s < first else out[s - first]
    for a, b in rules.tolist():
        out.append(size(a) + size(b))
    return np.array(out, "<u4")


def write_block(docs: list[int | None], ids: list[bytes], least: int = 16) -> bytes:
    seq, rules, first = compress(np.frombuffer(b"".join(ids), "<u4"), least)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    lengths = np.array([len(x) // 4 for x in ids], "<u4")
    return b"".join([
        HEAD.pack(b"RPG1", width, first, len(docs), len(rules), len(seq), int(lengths.sum())),
        np.array([0 if d is None else d for d in docs], "<i8").tobytes(), np.array([d is None for d in docs], "u1").tobytes(), lengths.tobytes(),
        rules.astype("<u4").tobytes(), lengths_of(rules, first).tobytes(), seq.astype(f"<u{width}").tobytes()])


class Block:
    """Reads a block; ``ids(start, n)`` expands only the symbols that cover the asked range."""

    def __init__(self, data: bytes) -> None:
        magic, width, self.first, n_docs, n_rules, n_symbols, self.n_ids = HEAD.unpack_from(data)
        if magic != b"RPG1":
            raise ValueError("not a grammar block")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, kind, n, at)
            at += x.nbytes
            return x

        docs, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.docs = [None if z else d for d, z in zip(docs.tolist(), nulls)]
        self.lengths = take("<u4", n_docs).astype(np.int64)
        self.rules, self.sizes = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols).astype(np.int64)
        # where each symbol's expansion ends in the block
        self.ends = np.cumsum(np.r_[np.ones(self.first, np.int64), self.sizes][self.symbols]) if n_symbols else np.zeros(0, np.int64)
        # expansions of all rules one after another, all deepened together
        flat = np.arange(self.first, self.first + n_rules)
        while (deep := flat >= self.first).any():
            size = 1 + deep
            at = np.cumsum(size) - size
            pairs = self.rules[flat[deep] - self.first]
            flat = np.repeat(flat, size)
            flat[at[deep]], flat[at[deep] + 1] = pairs[:, 0], pairs[:, 1]
        self.flat = np.r_[np.arange(self.first), flat].astype("<u4")
        self.offsets = np.r_[np.arange(self.first), self.first + np.cumsum(np.r_[0, self.sizes[:-1]])] if n_rules else np.arange(self.first)

    def ids(self, start: int = 0, n: int | None = None) -> np.ndarray:
        stop = self.n_ids if n is None else min(start + n, self.n_ids)
        if stop <= start:
            return np.empty(0, "<u4")
        i, j = np.searchsorted(self.ends, [start, stop - 1], side="right")
        ends = self.ends[i : j + 1]
        base = int(self.ends[i - 1]) if i else 0
        sizes = np.diff(np.r_[base, ends])
        where = np.repeat(self.offsets[self.symbols[i : j + 1]] - (ends - sizes - base), sizes) + np.arange(int(ends[-1]) - base)
        return self.flat[where][start - base : stop - base].astype("<u4")


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, block = TaskContext.get().partitionId(), 0
    end = np.array([end_id], "<u4").tobytes()
    docs: list = []
    ids: list[bytes] = []
    held = 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([held // 4], pa.int64()), pa.array([write_block(docs, ids)], pa.binary())], ["part", "block", "n_ids", "data"])

    for b in batches:
        for doc, x in zip(b.column(0).to_pylist(), encode_column(b.column(1), path)):
            docs.append(doc)
            ids.append(x + end)
            held += len(x) + 4
            if held >= 4 * BLOCK:
                yield close()
                docs, ids, held, block = [], [], 0, block + 1
    if docs:
        yield close()


def write(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Encode documents and write them in ascending order of id; the table of blocks and its path.

    Null texts count as empty (the end id alone); null ids come first; rows that repeat an id follow
    each other in order of text; an empty table writes no block; other columns are not read.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return store(ordered.mapInArrow(lambda it: _write(it, path, end_id), "part int, block int, n_ids long, data binary"), "token-ids")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start, data in zip(b.column(0), b.column(1)):
            x = Block(data.as_py())
            ids, ends = x.ids().tobytes(), np.cumsum(x.lengths, dtype=np.int64)
            at = ends - x.lengths
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.docs, pa.int64()), pa.array(at + start.as_py(), pa.int64()), pa.array([ids[4 * i : 4 * j] for i, j in zip(at.tolist(), ends.tolist())], pa.binary())],
                ["doc_id", "start", "ids"])


def read(blocks: DataFrame) -> DataFrame:
    """Decode a table of blocks: doc_id, start (ids of all documents before it), ids (little-endian u32)."""
    sizes = blocks.groupBy("part", "block").agg(F.sum("n_ids").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # one row a file part
    parts = parts.select("part", before(Window.orderBy("part")).alias("_p"))
    starts = sizes.select("part", "block", before(Window.partitionBy("part").orderBy("block")).alias("_b")).join(parts, "part").select("part", "block", (F.col("_p") + F.col("_b")).alias("_start"))
    starts, _ = store(starts, "starts")  # its size is known when the join with the blocks is planned
    placed = blocks.select("part", "block", "data").join(starts, ["part", "block"])
    return placed.select("_start", "data").mapInArrow(_read, "doc_id long, start long, ids binary")
