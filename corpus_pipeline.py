"""Corpus pipeline: language ID, exact dedup, MinHash near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from approxspark.llm import exact_dedup, language_id, minhash_dedup, mixing, packing
from approxspark.session import drop_stored, ensure_checkpoint_dir, ship_package, store, stored_so_far
from approxspark.sources.tables import table


def _stage(fn: Callable) -> Callable:
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, docs, sf_dir)

    return run


def _kept_by(docs: DataFrame, decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Rows of ``docs`` that ``decide`` (rows with a stored key, the key's name) -> (row, kept) keeps. Ids may repeat
    or be null, so rows go by a key of their own, under a name that no column has."""
    key = "_row"
    while key.lower() in map(str.lower, docs.columns):
        key += "_"
    keyed, _ = store(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    kept = decide(keyed, key).where("kept").select(F.col("row").alias(key))
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the stage's labelled documents and let the rejected ones go (no letter, or far from every
    language learnt). Rows are judged by themselves: nothing is joined."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.accepted(docs, model)


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return _kept_by(docs, lambda rows, key: exact_dedup.exact_dedup(rows, row_col=key))


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays."""
    return _kept_by(docs, lambda rows, key: minhash_dedup.near_duplicates(rows, row_col=key))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, always whole. A document that the mix doesn't take goes."""
    # a document's columns travel in one, so that none can clash with the mix's own
    mixed = mixing.mix(docs.select("doc_id", "text", "source", F.struct("*").alias("_document")), keep=["_document"], whole=True)
    # documents without words weigh nothing: they stay once
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    return mixed.select(F.explode(F.array_repeat("_document", copies)).alias("_document")).select("_document.*")


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: SQL expresses neither the learnt language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark = stored_so_far()
        docs, path = store(stage(spark, docs, sf_dir), name)
        drop_stored(spark, mark, path)  # what the stage wrote on its way
    return STAGES[-1][1](spark, docs, sf_dir)
