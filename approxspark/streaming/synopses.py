"""Structured Streaming synopses.

Appended data arrives through ``readStream``. Built-in streaming aggregates keep running
counts/sums, HLL sketches and Count-Min cells in the state store (exactly-once through the
checkpoint). Bottom-k reservoirs are kept with ``foreachBatch``: state version ``batch=<id>`` is
the bottom-k of (version ``<id - 1>`` union the micro-batch), written with overwrite, so a
replayed batch rewrites the same version (idempotent). The reservoir of a union is the bottom-k
of the parts, so the state equals the batch answer whatever the batching. Of the versions the last
``RETAIN`` are kept: one to read, one to replay from, and one for readers that began before.
``current`` finds the last version that is written whole, so that the state answers at any moment while the
stream runs.

All state lives under the shared checkpoint folder (spark.checkpoint.dir).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import as_list, priority
from ..operators import approximate, samplers
from ..operators.joins import join_keys
from ..operators.sketches import HLL_LG_K, cms_build
from ..session import drop_scratch, list_scratch, scratch_path


def require_streaming(df: DataFrame) -> None:
    """Appends are only accepted on a streaming source."""
    if not df.isStreaming:
        raise ValueError("Cannot add streaming data to a batch source")


def stage_batches(df: DataFrame, name: str, order_by: str, rows_per_file: int = 1_000_000, least: int = 4) -> tuple[str, int]:
    """Write a copy of ``df`` in files of about ``rows_per_file`` rows (``least`` files at least), one per
    range of ``order_by``, to replay as a stream; its path and the number of files."""
    path = scratch_path(df.sparkSession, name)
    parts = max(least, -(-df.count() // rows_per_file))
    df.repartitionByRange(parts, order_by).write.parquet(path)
    return path, parts


def stream_source(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A2: append-only parquet stream, one file per micro-batch by default."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


#: Versions kept: the last, the one that a replayed batch starts from, and one that readers may still be in.
RETAIN = 3


def _start(stream: DataFrame, mode: str, handler: Callable[[DataFrame, int], None], ckpt: str, trigger: Mapping) -> StreamingQuery:
    require_streaming(stream)
    return stream.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", ckpt).trigger(**trigger).start()


def _finish(q: StreamingQuery, name: str, timeout: float | None) -> None:
    """Wait for what is there to be processed; ``timeout`` seconds are the caller's limit (none by default)."""
    finished = q.awaitTermination() if timeout is None else q.awaitTermination(timeout)
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish within {timeout}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removeprefix("batch=")) for n in list_scratch(spark, folder) if n.startswith("batch="))


def current(spark: SparkSession, *folders: str) -> int | None:
    """The last version that all ``folders`` hold whole (their writers' mark is there); None before the first."""
    for v in reversed(_versions(spark, folders[0])):
        if all("_SUCCESS" in list_scratch(spark, f"{f}/batch={v}") for f in folders):
            return v
    return None


def _last_version(spark: SparkSession, name: str, *folders: str) -> int:
    """The last version that a run has written, this one or an earlier one of the same folder."""
    found = current(spark, *folders)
    if found is None:
        raise RuntimeError(f"stream {name} has not seen any data yet")
    return found


def _retire(spark: SparkSession, batch_id: int, retain: int | None, *folders: str) -> None:
    """Delete versions before the last ``retain`` (2 at least: a replayed batch starts from the one before)."""
    if retain is not None:
        drop_scratch(spark, *[f"{f}/batch={v}" for f in folders for v in _versions(spark, f) if v <= batch_id - max(2, retain)])


def run_versioned(stream: DataFrame, mode: str, name: str, path: str | None = None, timeout: float | None = None, retain: int | None = RETAIN) -> tuple[DataFrame, list[str]]:
    """Run a streaming aggregate to completion; each micro-batch's output is written as version
    ``batch=<id>``. Returns (final version, paths of this run's kept versions in order). With ``path``
    the versions and the checkpoint (state store) live in a named folder, so a later run resumes;
    if nothing new has arrived, the final version is the last one committed. The last ``retain`` versions are
    kept, all with None; :func:`current_aggregates` reads the last while the stream runs."""
    spark = stream.sparkSession
    out = path or scratch_path(spark, name)
    _finish(start_aggregates(stream, mode, out, retain, availableNow=True), name, timeout)
    return spark.read.parquet(f"{out}/batch={_last_version(spark, name, out)}"), [f"{out}/batch={v}" for v in _versions(spark, out)]


def start_aggregates(stream: DataFrame, mode: str, path: str, retain: int | None = RETAIN, **trigger) -> StreamingQuery:
    """Start a streaming aggregate that keeps its versions below ``path`` (see :func:`run_versioned`); ``trigger`` as of writeStream."""
    spark = stream.sparkSession

    def handler(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        _retire(spark, batch_id, retain, path)

    return _start(stream, mode, handler, f"{path}/_checkpoint", trigger)


def current_aggregates(spark: SparkSession, path: str) -> DataFrame | None:
    """The aggregates over all that has been committed so far; None before the first batch."""
    v = current(spark, path)
    return None if v is None else spark.read.parquet(f"{path}/batch={v}")


def running_aggregates(events: DataFrame, aggs, by: str | Sequence[str] | None = None) -> DataFrame:
    """G1: running aggregates over everything appended (complete mode)."""
    by = as_list(by)
    return events.groupBy(*by).agg(*aggs) if by else events.agg(*aggs)


def running_hll(events: DataFrame, column: str) -> DataFrame:
    """Incremental distinct sketch; the estimate can only grow as data is appended."""
    return events.agg(F.hll_sketch_agg(F.col(column), HLL_LG_K).alias("sketch")).select(
        F.hll_sketch_estimate("sketch").alias("approx_distinct"), "sketch"
    )


def running_cms(events: DataFrame, key: str) -> DataFrame:
    """Incremental Count-Min table (streaming groupBy on depth_row, bucket)."""
    return cms_build(events, key)


def reservoir_stream(stream: DataFrame, k: int, key: str | Sequence[str], seed: int, name: str,
                     strata: str | Sequence[str] | None = None, counts: bool = False,
                     path: str | None = None, timeout: float | None = None, weight: str | None = None, retain: int | None = RETAIN) -> dict[str, str]:
    """A reservoir kept over what there is of a stream (see :func:`start_reservoir`). Returns the final state's paths.

    ``path`` keeps state and checkpoint in a named folder, so a later run (e.g. after a driver
    restart, or when new files arrive) resumes from the last committed batch, whose state is returned
    if nothing new has arrived.
    """
    spark = stream.sparkSession
    out = path or scratch_path(spark, name)
    folders = [f"{out}/reservoir", *([f"{out}/counts"] if counts else [])]
    before = current(spark, *folders)
    _finish(start_reservoir(stream, k, key, seed, out, strata, counts, weight, retain, availableNow=True), name, timeout)
    last = _last_version(spark, name, *folders)
    return {f.rpartition("/")[2]: f"{f}/batch={last}" for f in folders} | {"batches": str(last - (-1 if before is None else before))}


def start_reservoir(stream: DataFrame, k: int, key: str | Sequence[str], seed: int, path: str,
                    strata: str | Sequence[str] | None = None, counts: bool = False, weight: str | None = None,
                    retain: int | None = RETAIN, **trigger) -> StreamingQuery:
    """Start a bottom-k reservoir (per stratum, NULL being one; or weighted, by ``weight``, without strata) maintained by
    foreachBatch below ``path``; with ``counts`` also the exact running row count per stratum, merged the same way.
    ``trigger`` as of writeStream. :func:`current_reservoir` reads the state while the stream runs.

    Per micro-batch, read once: rows that cannot enter a full reservoir (priority above its current
    maximum) are dropped, the rest and the previous version are sampled together by the samplers, which
    sort no stratum in one task. Versions before the last ``retain`` are deleted.
    """
    spark = stream.sparkSession
    strata = as_list(strata)
    if weight and strata:
        raise ValueError("a weighted reservoir has no strata")
    folders = [f"{path}/reservoir", *([f"{path}/counts"] if counts else [])]

    def handler(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            (_advance_weighted if weight else _advance)(batch, batch_id)
            if counts:
                c = batch.groupBy(*strata).agg(F.count(F.lit(1)).cast("long").alias("rows"))
                if batch_id > 0:
                    c = c.unionByName(spark.read.parquet(f"{path}/counts/batch={batch_id - 1}"))
                c.groupBy(*strata).agg(F.sum("rows").cast("long").alias("rows")).write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")
        finally:
            batch.unpersist()
        _retire(spark, batch_id, retain, *folders)

    def _advance_weighted(batch: DataFrame, batch_id: int) -> None:
        drawn = samplers.weighted(batch, k, key, weight, seed)
        if batch_id > 0:
            drawn = samplers.merge_weighted(k, key, drawn, spark.read.parquet(f"{path}/reservoir/batch={batch_id - 1}"))
        drawn.write.mode("overwrite").parquet(f"{path}/reservoir/batch={batch_id}")

    def _advance(batch: DataFrame, batch_id: int) -> None:
        # every batch writes a version, so the previous state is always batch_id - 1 (also after
        # a driver restart that resumes from the checkpoint)
        cur = batch.withColumn("_prio", priority(key, seed))
        if batch_id > 0:
            prev = spark.read.parquet(f"{path}/reservoir/batch={batch_id - 1}")
            # exact cut: once a (stratum's) reservoir is full, only rows below its largest
            # priority can enter
            full = F.when(F.count(F.lit(1)) >= k, F.max("_prio")).alias("_limit")
            if strata:
                cur = join_keys(cur, prev.groupBy(*strata).agg(full), strata, "left").where("_limit IS NULL OR _prio <= _limit").drop("_limit")
            else:
                limit = prev.agg(full).first()[0]
                cur = cur if limit is None else cur.where(F.col("_prio") <= F.lit(limit))
            cur = cur.unionByName(prev)
        samplers.reservoir(cur.drop("_prio"), k, key, seed, strata=strata or None).withColumn("_prio", priority(key, seed)).write.mode("overwrite").parquet(f"{path}/reservoir/batch={batch_id}")

    return _start(stream, "append", handler, f"{path}/_checkpoint", trigger)


def current_reservoir(spark: SparkSession, path: str, counts: bool = False) -> dict[str, DataFrame] | None:
    """The reservoir (and the running counts) over all that has been committed so far, both of one version; None before
    the first batch. It can be read until ``retain`` - 1 more batches have passed."""
    folders = [f"{path}/reservoir", *([f"{path}/counts"] if counts else [])]
    v = current(spark, *folders)
    return None if v is None else {f.rpartition("/")[2]: spark.read.parquet(f"{f}/batch={v}") for f in folders}


def answer(state: Mapping[str, DataFrame], aggs, by: str | Sequence[str], where=None, intervals: bool = False) -> DataFrame:
    """Approximate aggregates from a stratified reservoir and its running counts, as from any stratified sample:
    ``by`` may be other columns than the strata. The counts' columns but ``rows`` are the strata."""
    strata = [c for c in state["counts"].columns if c != "rows"]
    taken = state["reservoir"].groupBy(*strata).agg(F.count(F.lit(1)).alias("take_n"))
    sizes = join_keys(state["counts"].withColumnRenamed("rows", "pop_n"), taken, strata)
    return approximate.estimate(join_keys(state["reservoir"], sizes, strata), aggs, by, strata, where, intervals=intervals)
