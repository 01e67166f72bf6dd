"""Operator 5: language identification by nearest clustered centroids of TF-IDF n-grams.

A text is the vector of its letter bigrams and trigrams (lower-cased, words padded by a boundary,
hashed to ``DIMS`` bins), weighted log(1 + count) * idf and scaled to length 1. Document frequencies
are counted over all learning rows. Each language gets ``clusters`` centroids by spherical k-means on
a bounded, seeded sample of its labelled texts (``sample`` a language); a text takes the language of
the centroid of greatest cosine. It is rejected when it has no letter, or when it is farther from that centroid than
texts of the language with as many n-grams are. How far these are is learnt from a third of the sample that
the centroids don't see, whole and in beginnings of 1, 2, 4 ... words, since a short text shares few n-grams with
any centroid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

DIMS = 1 << 14
#: Characters turned into n-grams at a time; a longer text is counted in such pieces.
PIECE = 1 << 18

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower-cased one if it is a letter, else 0."""
    if not _tables:
        t = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _tables.append(t)
    return _tables[0]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter bigrams and trigrams of the whole text; None without a letter."""
    if not text:
        return None
    total = np.zeros(DIMS, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    tail, any_letter = np.zeros(1, np.uint32), False
    for at in range(0, len(points), PIECE):
        c = np.concatenate([tail, _letters()[points[at : at + PIECE]]] + ([np.zeros(1, np.uint32)] if at + PIECE >= len(points) else []))
        c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]].astype(np.uint32)  # one boundary between words
        any_letter = any_letter or bool(c.any())
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
        three = three[c[1:-1] != 0]  # not across a boundary
        for g in (two[len(tail) - 1 :], three):  # the tail's own bigram was counted with its piece
            g = (g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            total += np.bincount(g >> np.uint32(18), minlength=DIMS)
        tail = c[-2:]
    return total if any_letter else None


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero bins and their weights, of length 1."""
    at = np.flatnonzero(counts)
    v = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt(v @ v)
    return at, (v / norm if norm else v).astype(np.float32)


#: Classes of a text's size: powers of two of its distinct n-grams.
SIZES = DIMS.bit_length() + 1


def size_class(n: int) -> int:
    return max(0, int(n)).bit_length()


@dataclass
class Model:
    """Centroids (one column each, of length 1), their languages, idf, and for each language the least cosine that
    isn't rejected by the size of the text (powers of two of its distinct n-grams)."""

    langs: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray

    def predict(self, text: str | None) -> tuple[str | None, float, bool]:
        """(language, cosine, rejected); the language is None without letters or without a learned language."""
        counts = ngram_counts(text)
        if counts is None or not self.langs:
            return None, 0.0, True
        at, v = vector(counts, self.idf)
        scores = v @ self.centroids[at]
        best = int(np.argmax(scores))
        score = float(min(1.0, max(0.0, scores[best])))
        return self.langs[self.owner[best]], score, score < self.floors[self.owner[best], size_class(len(at))]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over a partition: in how many texts each bin occurs; bin -1 counts the texts with letters."""
    n, df = 0, np.zeros(DIMS, np.int64)
    for b in batches:
        for text in b.column(0):
            counts = ngram_counts(text.as_py())
            if counts is not None:
                n += 1
                df += counts > 0
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n, df[at]], pa.int64())], ["bin", "n"])


def _beginnings(text: str) -> Iterator[str]:
    """The text and its beginnings of 1, 2, 4 ... words."""
    words, n = text.split(), 1
    while n < len(words):
        yield " ".join(words[:n])
        n *= 2
    yield text


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of learning texts: language, hash, whether it sets limits, bins and counts; of those that do also their beginnings."""
    for b in batches:
        out = []
        for lang, h, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            limits = h % 3 == 0
            for part in _beginnings(text) if limits else [text]:
                c = ngram_counts(part)
                if c is not None:
                    at = np.flatnonzero(c)
                    out.append((lang, h, limits, at.astype("<i4").tobytes(), c[at].astype("<i4").tobytes()))
        if out:
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["lang", "h", "limits", "bins", "counts"])


def _cluster(x: np.ndarray, k: int, turns: int = 8) -> np.ndarray:
    """Spherical k-means; starts are spread out: each is the row farthest from those before."""
    k = min(k, len(x))
    start = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[start[0]]
    for _ in range(k - 1):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(turns):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.linalg.norm(c, axis=1, keepdims=True)
    return c


def _learn(rows: pd.DataFrame, idf: np.ndarray, clusters: int, quantile: float, margin: float) -> pd.DataFrame:
    """Centroids of one language, and its limits by size: ``margin`` times a low quantile of the cosines that texts not
    seen by the centroids have (NaN for sizes that none of them has)."""
    rows = rows.sort_values(["h", "bins", "counts"])
    parts = []
    for bins, counts in zip(rows["bins"], rows["counts"]):
        full = np.zeros(DIMS, np.int64)
        full[np.frombuffer(bins, "<i4")] = np.frombuffer(counts, "<i4")
        parts.append(vector(full, idf))
    limits = rows["limits"].to_numpy(bool)
    seen = np.flatnonzero(~limits) if (~limits).any() else np.arange(len(parts))  # a language of a few texts
    x = np.zeros((len(seen), DIMS), np.float32)
    for i, j in enumerate(seen):
        x[i, parts[j][0]] = parts[j][1]
    c = _cluster(x, clusters)
    found: dict[int, list[float]] = {}
    for j in np.flatnonzero(limits):
        at, v = parts[j]
        found.setdefault(size_class(len(at)), []).append(float((c[:, at] @ v).max()))
    floors = np.full(SIZES, np.nan)
    for size, cosines in found.items():
        floors[size] = margin * max(0.0, float(np.quantile(cosines, quantile)))
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "cents": [c.astype("<f4").tobytes()], "floors": [floors.tolist()]})


def _filled(floors: np.ndarray) -> np.ndarray:
    """Limits of all sizes: one never seen takes that of the next smaller one, none before the first; larger texts never
    get a lower limit than smaller ones."""
    return np.maximum.accumulate(np.where(np.isnan(floors), 0.0, floors), axis=1) if len(floors) else floors


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", sample: int = 300, clusters: int = 4, quantile: float = 0.01, margin: float = 0.5) -> Model:
    """Learn from labelled rows: idf over all of them, centroids and limits from at most ``sample`` texts a language.

    A third of a language's texts sets its limits: ``margin`` times the ``quantile`` of their cosines to the
    centroids of the others, by size. What lies much farther from all centroids than any such text is rejected. The sample
    is drawn by the texts' hashes (equal texts count once), so ids may repeat or be null. Centroids are learnt in one
    task a language; the driver sees a few centroids of each.
    """
    rows = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    df = rows.select("text").mapInArrow(_frequencies, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()  # DIMS + 1 rows at most
    n = next((r["n"] for r in df if r["bin"] < 0), 0)
    idf = np.full(DIMS, np.log(1.0 + n))
    for r in df:
        if r["bin"] >= 0:
            idf[r["bin"]] = np.log((1.0 + n) / (1.0 + r["n"])) + 0.1
    hashed = rows.withColumn("h", F.xxhash64("text"))
    lettered = hashed.where(F.col("text").rlike(r"\p{L}")).select("lang", "h").distinct()
    w = Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h")
    chosen = lettered.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= sample).select("lang", "h")
    chosen, _ = store(chosen, "learning-texts")  # a bounded number a language: Spark knows its size
    drawn = hashed.join(chosen, ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "h", "text").mapInArrow(_vectors, "lang string, h long, limits boolean, bins binary, counts binary")
    learnt = drawn.groupBy("lang").applyInPandas(lambda g: _learn(g, idf, clusters, quantile, margin), "lang string, cents binary, floors array<double>").collect()
    learnt = sorted(learnt, key=lambda r: r["lang"])
    cents = [np.frombuffer(r["cents"], "<f4").reshape(-1, DIMS) for r in learnt]
    owner = np.repeat(np.arange(len(learnt)), [len(c) for c in cents])
    centroids = np.ascontiguousarray(np.concatenate(cents).T) if cents else np.zeros((DIMS, 0), np.float32)
    floors = _filled(np.array([r["floors"] for r in learnt], np.float64).reshape(len(learnt), SIZES))
    return Model([r["lang"] for r in learnt], owner.astype(np.int64), centroids, idf, floors)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred (``und`` without letters), score (cosine, 0 to 1), rejected.

    Null and empty texts have no letters. Repeated rows are predicted each; an empty table gives no
    rows; other columns are not read.
    """
    # the model's size is fixed: DIMS bins by a few centroids a language
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x or "und" for x, _, _ in found], pa.string()), pa.array([s for _, s, _ in found], pa.float64()), pa.array([bool(r) for _, _, r in found], pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not shared.value.predict(t.as_py())[2] for t in b.column(place)], pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)


def held_out(id_col: str = "doc_id", mod: int = 4, rest: int = 2) -> Column:
    """Is crc32 of the id as text, modulo ``mod``, equal to ``rest``? (A null id is not held out.)"""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))
