"""Operator 8: a hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The class is predicted by a softmax over
hashed features of the history: the endings of the last word and, skipping, of the two before it, and
the pair of the last two words' classes. Classes are the end of a text, the most frequent words (one
each), and the other words by ending. P(word | class) is smoothed like the base score.

The corpus is coded once into chunks of whole texts with a dictionary of word hashes each. A word's
count over all training texts comes from slots by hash: every chunk sends its dictionary, a slot adds
up and answers each chunk. What is sent follows the corpus, and no vocabulary is held in one place.
Training is one pass of gradient updates: each partition updates its own copy of the weights (row-wise
AdaGrad) over its chunks, copies are averaged by how often a row was updated, in ``rounds`` steps over
disjoint parts of the chunks. The model has a fixed size (4 MB). Scoring reads chunks in numpy batches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_scratch, store

#: Tokens of a chunk (at least one text), dictionary entries of a slot, tokens of a gradient step.
CHUNK, SLOT, STEP = 2_000_000, 1_000_000, 4096
CLASSES, SINGLE, CODES = 64, 31, 4096
#: Hash of the end of a text; words have no white space, so none is this text.
END = xxhash.xxh3_64_intdigest(b"\n")
#: Rows of a block of the weights.
BLOCK = 1024
ROWS = 4 * CODES


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base, made = TaskContext.get().partitionId() << 32, 0
    names = ["chunk", "doc_ids", "train", "lengths", "tokens", "hashes", "classes", "codes", "n_words"]

    def close() -> pa.RecordBatch:
        words = list(index)
        hashes = np.array([END] + [xxhash.xxh3_64_intdigest(w) for w in words[1:]], "<u8")
        classes = np.array([0] + [1 + SINGLE + xxhash.xxh32_intdigest(w[-2:]) % (CLASSES - 1 - SINGLE) for w in words[1:]], "u1")
        codes = np.array([0] + [1 + xxhash.xxh32_intdigest(w[-3:]) % (CODES - 1) for w in words[1:]], "<u2")
        cols = [[base + made], [ids], [train], [np.array(lengths, "<i4").tobytes()], [np.concatenate(tokens).tobytes()], [hashes.tobytes()], [classes.tobytes()], [codes.tobytes()], [len(words)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 5, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def fresh() -> dict:
        d: dict = defaultdict(count().__next__)
        d[b"\n"]  # the end is entry 0
        return d

    index, ids, train, lengths, tokens, held = fresh(), [], [], [], [], 0
    for b in batches:
        for doc, learn, text in zip(b.column(0), b.column(1), b.column(2)):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
            words.append(b"\n")
            tokens.append(np.fromiter(map(index.__getitem__, words), "<i4", len(words)))
            ids.append(doc.as_py())
            train.append(bool(learn.as_py()))
            lengths.append(len(words))
            held += len(words)
            if held >= CHUNK:
                yield close()
                made += 1
                index, ids, train, lengths, tokens, held = fresh(), [], [], [], [], 0
    if ids:
        yield close()


def _train_mask(train: list, lengths: np.ndarray) -> np.ndarray:
    return np.repeat(np.array(train, bool), lengths)


def _requests(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A chunk's dictionary by slot, in order of hash, with the counts of its training texts."""
    for b in batches:
        for r in b.to_pylist():
            hashes = np.frombuffer(r["hashes"], "<u8")
            tokens, lengths = np.frombuffer(r["tokens"], "<i4"), np.frombuffer(r["lengths"], "<i4")
            n = np.bincount(tokens[_train_mask(r["train"], lengths)], minlength=len(hashes))
            order = np.argsort(hashes)
            h, n, c = hashes[order], n[order].astype("<u4"), np.frombuffer(r["classes"], "u1")[order]
            slot = (h >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(slot)) + 1
            parts = list(zip(np.split(slot, cuts), np.split(h, cuts), np.split(n, cuts), np.split(c, cuts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p[0][0]) for p in parts], pa.int64()), pa.array([r["chunk"]] * len(parts), pa.int64()), *(pa.array([p[i].tobytes() for p in parts], pa.binary()) for i in (1, 2, 3))],
                ["slot", "chunk", "hashes", "counts", "classes"])


def _answers(slot: pd.DataFrame) -> pd.DataFrame:
    """Total counts of a slot's words, answered to each chunk in the order asked; a row -1 - slot has the slot's sums."""
    hashes = [np.frombuffer(x, "<u8") for x in slot["hashes"]]
    words, first, at = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([np.frombuffer(x, "<u4") for x in slot["counts"]]), minlength=len(words)).astype("<i8")
    classes = np.concatenate([np.frombuffer(x, "u1") for x in slot["classes"]])[first]
    rows = [(int(slot["slot"].iloc[0]), int(c), t.tobytes(), None, None, None) for c, t in zip(slot["chunk"], np.split(total[at], np.cumsum([len(h) for h in hashes])[:-1]))]
    sums = np.bincount(classes, weights=total, minlength=CLASSES).astype(np.int64)
    kinds = np.bincount(classes, weights=total > 0, minlength=CLASSES).astype(np.int64)
    word = (total > 0) & (words != END)
    top = np.lexsort((words, -total * word))[:SINGLE]
    rows.append((int(slot["slot"].iloc[0]), -1 - int(slot["slot"].iloc[0]), None, sums.tolist(), kinds.tolist(),
                 [{"n": int(total[i]), "hash": int(words[i : i + 1].view(np.int64)[0]), "class": int(classes[i])} for i in top if word[i]]))
    return pd.DataFrame(rows, columns=["slot", "chunk", "counts", "sums", "kinds", "top"])


class Chunk:
    """A chunk's arrays for training and scoring."""

    def __init__(self, r: dict, stats: dict) -> None:
        self.ids, self.lengths = r["doc_ids"], np.frombuffer(r["lengths"], "<i4")
        self.tokens = np.frombuffer(r["tokens"], "<i4")
        self.train = _train_mask(r["train"], self.lengths)
        hashes = np.frombuffer(r["hashes"], "<u8")
        counts = np.empty(len(hashes), np.int64)
        counts[np.argsort(hashes)] = np.concatenate([np.frombuffer(a["counts"], "<i8") for a in sorted(r["answers"], key=lambda a: a["slot"])])
        classes = np.frombuffer(r["classes"], "u1").copy()
        for k, h in enumerate(stats["single"]):
            classes[hashes == np.uint64(h)] = 1 + k
        self.counts = counts
        word = np.log10((counts + 0.1) / (stats["sums"][classes] + 0.1 * (stats["kinds"][classes] + 1)))
        word[classes <= SINGLE] = 0.0  # a class of one
        self.word = word
        c, e = classes[self.tokens], np.frombuffer(r["codes"], "<u2")[self.tokens].astype(np.int32)
        self.target = c.astype(np.int64)
        place = np.arange(len(c)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

        def back(x: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros_like(x)
            out[k:] = x[:-k] if k < len(x) else 0
            out[place < k] = 0
            return out

        self.features = np.stack([back(e, 1), CODES + back(e, 2), 2 * CODES + back(c.astype(np.int32), 1) * CLASSES + back(c.astype(np.int32), 2), 3 * CODES + back(e, 3)])


def _softmax(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = weights[f[0]]
    for k in (1, 2, 3):
        z += weights[f[k]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _gradients(batches: Iterator[pa.RecordBatch], shared, rate: float) -> Iterator[pa.RecordBatch]:
    """Gradient updates of a copy of the weights over a partition's training texts."""
    from pyspark import TaskContext

    weights, bias, stats = shared.value
    weights, seen, mass = weights.copy(), np.zeros(ROWS, np.float32), np.full(ROWS, 1e-3, np.float32)
    for b in batches:
        for i in range(b.num_rows):
            c = Chunk(b.slice(i, 1).to_pylist()[0], stats)
            f, y = c.features[:, c.train], c.target[c.train]
            for at in range(0, len(y), STEP):
                g, fs = _softmax(weights, bias, f[:, at : at + STEP]), f[:, at : at + STEP]
                g[np.arange(len(g)), y[at : at + STEP]] -= 1.0
                for k in range(4):
                    order = np.argsort((fs[k] - k * CODES).astype(np.uint16), kind="stable")
                    rows = fs[k][order]
                    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    s, rows = np.add.reduceat(g[order], starts, axis=0), rows[starts]
                    seen[rows] += np.diff(np.r_[starts, len(order)])
                    mass[rows] += np.einsum("ij,ij->i", s, s) / CLASSES
                    weights[rows] -= rate * s / np.sqrt(mass[rows])[:, None]
    n, part = ROWS // BLOCK, TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int32()), pa.array([part] * n, pa.int64()), pa.array([(w * s[:, None]).astype("<f4").tobytes() for w, s in zip(np.split(weights, n), np.split(seen, n))], pa.binary()), pa.array([s.astype("<f4").tobytes() for s in np.split(seen, n)], pa.binary())],
        ["block", "part", "weights", "seen"])


def _added(copies: pd.DataFrame) -> pd.DataFrame:
    w, s = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in copies["weights"]), sum(np.frombuffer(x, "<f4").astype(np.float64) for x in copies["seen"])
    return pd.DataFrame({"block": [copies["block"].iloc[0]], "part": [copies["part"].iloc[0]], "weights": [w.astype("<f4").tobytes()], "seen": [s.astype("<f4").tobytes()]})


def _scores(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    weights, bias, stats = shared.value
    for b in batches:
        for i in range(b.num_rows):
            c = Chunk(b.slice(i, 1).to_pylist()[0], stats)
            model = np.empty(len(c.tokens))
            for at in range(0, len(model), STEP):
                p = _softmax(weights, bias, c.features[:, at : at + STEP])
                model[at : at + STEP] = p[np.arange(len(p)), c.target[at : at + STEP]]
            model = np.log10(np.maximum(model, 1e-30)) + c.word[c.tokens]
            base = np.log10((c.counts + 0.1) / (stats["N"] + 0.1 * (stats["V"] + 1)))[c.tokens]
            starts = np.cumsum(c.lengths) - c.lengths
            add = lambda x: np.add.reduceat(x, starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.ids, pa.int64()), pa.array(c.lengths, pa.int64()), pa.array(add((c.counts > 0).astype(np.int64)[c.tokens]), pa.int64()), pa.array([stats["N"]] * len(c.ids), pa.int64()), pa.array(add(base), pa.float64()), pa.array(add(model), pa.float64())],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2, rate: float = 0.15) -> DataFrame:
    """Learn from the rows where ``train`` holds (null: not) and score all: one row per document.

    Columns: doc_id, n_tokens (words and one end), n_known (tokens that training texts have),
    train_tokens, base_score and score (log10 probabilities of the text by smoothed token frequencies
    and by the model). Null texts count as empty: the end alone. Repeated rows are documents of their
    own; a null id is scored too; without training rows every token is unknown; an empty table gives
    no rows; other columns are not read. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    chunks, chunk_path = store(rows.mapInArrow(_chunks, "chunk long, doc_ids array<long>, train array<boolean>, lengths binary, tokens binary, hashes binary, classes binary, codes binary, n_words long"), "chunks")
    asked = chunks.agg(F.sum("n_words")).first()[0] or 0
    bits = max(3, int(np.ceil(np.log2(max(1, asked / SLOT)))) + 1)
    slots = chunks.select("chunk", "train", "lengths", "tokens", "hashes", "classes").mapInArrow(lambda it: _requests(it, bits), "slot long, chunk long, hashes binary, counts binary, classes binary")
    answers, answer_path = store(slots.groupBy("slot").applyInPandas(_answers, "slot long, chunk long, counts binary, sums array<long>, kinds array<long>, top array<struct<n:long,hash:long,class:int>>"), "answers")
    sums = answers.where("chunk < 0").select(F.posexplode(F.arrays_zip("sums", "kinds")).alias("class", "z")).groupBy("class").agg(F.sum("z.sums").alias("n"), F.sum("z.kinds").alias("v")).collect()
    top = answers.where("chunk < 0").select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("n"), "hash").limit(SINGLE).collect()
    stats = {"sums": np.zeros(CLASSES), "kinds": np.zeros(CLASSES), "single": [r["hash"] % 2**64 for r in top]}
    for r in sums:
        stats["sums"][r["class"]], stats["kinds"][r["class"]] = r["n"], r["v"]
    stats["N"], stats["V"] = int(stats["sums"].sum()), int(stats["kinds"].sum())
    for k, r in enumerate(top):
        stats["sums"][r["class"]] -= r["n"]
        stats["kinds"][r["class"]] -= 1
        stats["sums"][1 + k], stats["kinds"][1 + k] = r["n"], 1
    replies = answers.where("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("slot", "counts")).alias("answers"))
    corpus, _ = store(chunks.join(replies, "chunk"), "corpus")
    drop_scratch(spark, chunk_path, answer_path)

    weights = np.zeros((ROWS, CLASSES), np.float32)
    bias = np.log((stats["sums"] + 0.1) / (stats["N"] + 0.1 * CLASSES)).astype(np.float32)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((weights, bias, stats))  # of fixed size
        part = corpus.where(F.pmod(F.xxhash64("chunk"), F.lit(rounds)) == k)
        copies = part.mapInArrow(lambda it, s=shared: _gradients(it, s, rate), "block int, part long, weights binary, seen binary")
        kind = "block int, part long, weights binary, seen binary"
        some = max(2, int(corpus.rdd.getNumPartitions() ** 0.5))  # copies are added in two steps of about as many each
        mean = copies.groupBy("block", F.pmod("part", F.lit(some)).alias("_g")).applyInPandas(_added, kind).groupBy("block").applyInPandas(_added, kind).collect()
        weights = weights.copy()
        for r in mean:
            s = np.frombuffer(r["seen"], "<f4")
            at = np.arange(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)[s > 0]
            weights[at] = np.frombuffer(r["weights"], "<f4").reshape(-1, CLASSES)[s > 0] / s[s > 0][:, None]
    shared = spark.sparkContext.broadcast((weights, bias, stats))
    return corpus.mapInArrow(lambda it: _scores(it, shared), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
