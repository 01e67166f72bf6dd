"""Streaming guards and stream == batch (reference: test_engine.py streaming tests)."""

import pytest

from approxspark.streaming import synopses


def test_batch_source_refuses_appends(events):
    with pytest.raises(ValueError):
        synopses.require_streaming(events)


def test_stream_source_is_streaming(spark, events):
    path, files = synopses.stage_batches(events.select("event_id", "value"), "t-stream", "event_id", least=3)
    assert files == 3
    s = synopses.stream_source(spark, path, events.select("event_id", "value").schema)
    synopses.require_streaming(s)


def test_stream_reservoir_equals_batch(spark, events):
    from approxspark.operators import samplers

    cols = events.select("event_id", "event_type")
    path, _ = synopses.stage_batches(cols, "t-res", "event_id", least=3)
    stream = synopses.stream_source(spark, path, cols.schema)
    paths = synopses.reservoir_stream(stream, 25, "event_id", 4, "t-res-out", strata="event_type")
    got = spark.read.parquet(paths["reservoir"]).select("event_id")
    want = samplers.reservoir(cols, 25, "event_id", 4, strata="event_type").select("event_id")
    assert int(paths["batches"]) >= 3
    assert got.count() == want.count() == 125 and got.subtract(want).count() == 0


def test_reservoir_resumes_after_restart(spark, events):
    # first run sees half of the files; new files arrive; a second run (fresh query object, same
    # state folder and checkpoint) resumes from the last committed version
    from pyspark.sql import functions as F

    from approxspark.operators import samplers
    from approxspark.session import scratch_path

    cols = events.select("event_id", "event_type")
    src = scratch_path(spark, "t-restart-src")
    state = scratch_path(spark, "t-restart")
    cols.where(F.col("event_id") < 5000).repartitionByRange(2, "event_id").write.mode("append").parquet(src)
    first = synopses.reservoir_stream(synopses.stream_source(spark, src, cols.schema), 30, "event_id", 6, "t-restart",
                                      strata="event_type", path=state)
    cols.where(F.col("event_id") >= 5000).repartitionByRange(2, "event_id").write.mode("append").parquet(src)
    second = synopses.reservoir_stream(synopses.stream_source(spark, src, cols.schema), 30, "event_id", 6, "t-restart",
                                       strata="event_type", path=state)
    assert first["reservoir"] != second["reservoir"]
    got = spark.read.parquet(second["reservoir"]).select("event_id")
    want = samplers.reservoir(cols, 30, "event_id", 6, strata="event_type").select("event_id")
    assert got.count() == want.count() == 150 and got.subtract(want).count() == 0
    # nothing new: the last committed version is returned
    third = synopses.reservoir_stream(synopses.stream_source(spark, src, cols.schema), 30, "event_id", 6, "t-restart",
                                      strata="event_type", path=state)
    assert third["reservoir"] == second["reservoir"] and third["batches"] == "0"


def test_running_aggregate_resumes(spark, events):
    from pyspark.sql import functions as F

    from approxspark.session import scratch_path

    cols = events.select("event_id", "event_type", "value")
    src = scratch_path(spark, "t-agg-src")
    state = scratch_path(spark, "t-agg")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")]
    cols.where(F.col("event_id") < 4000).write.mode("append").parquet(src)
    synopses.run_versioned(synopses.running_aggregates(synopses.stream_source(spark, src, cols.schema), aggs, "event_type"),
                           "complete", "t-agg", path=state)
    cols.where(F.col("event_id") >= 4000).write.mode("append").parquet(src)
    final, _ = synopses.run_versioned(synopses.running_aggregates(synopses.stream_source(spark, src, cols.schema), aggs, "event_type"),
                                      "complete", "t-agg", path=state)
    want = cols.groupBy("event_type").agg(*aggs)
    got = {r["event_type"]: (r["n"], round(r["s"], 4)) for r in final.collect()}
    exp = {r["event_type"]: (r["n"], round(r["s"], 4)) for r in want.collect()}
    assert got == exp


def test_append_is_refused_and_nothing_stays_cached(spark, events):
    with pytest.raises(ValueError, match="batch source"):
        synopses.reservoir_stream(events, 5, "event_id", 1, "t-guard")
    cols = events.selectExpr("event_id", "nullif(event_type, 'error') AS kind")
    path, _ = synopses.stage_batches(cols, "t-leak", "event_id")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    paths = synopses.reservoir_stream(synopses.stream_source(spark, path, cols.schema), 20, "event_id", 4, "t-leak-out", strata="kind", counts=True)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    state = {r["kind"]: r["n"] for r in spark.read.parquet(paths["reservoir"]).groupBy("kind").count().withColumnRenamed("count", "n").collect()}
    assert state == {k: 20 for k in state} and None in state and len(state) == 5


def test_answers_while_the_stream_runs(spark, events):
    # after each batch the state answers for exactly what has been committed, with a bounded number of versions
    from pyspark.sql import functions as F

    from approxspark.operators import samplers
    from approxspark.session import list_scratch, scratch_path

    cols = events.select("event_id", "event_type", "user_id", "value")
    src, state, sums = (scratch_path(spark, n) for n in ("t-live-src", "t-live", "t-live-sums"))
    parts = [cols.where(F.col("event_id") % 6 == i) for i in range(6)]
    parts[0].coalesce(1).write.mode("append").parquet(src)
    assert synopses.current_reservoir(spark, state) is None and synopses.current_aggregates(spark, sums) is None
    read = lambda: synopses.stream_source(spark, src, cols.schema)
    q = synopses.start_reservoir(read(), 30, "event_id", 6, state, strata="event_type", counts=True, processingTime="0 seconds")
    a = synopses.start_aggregates(synopses.running_aggregates(read(), [F.count(F.lit(1)).alias("n")], "event_type"), "complete", sums, processingTime="0 seconds")
    try:
        for i in range(6):
            if i:
                parts[i].coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
            a.processAllAvailable()
            seen = cols.where(F.col("event_id") % 6 <= i)
            now = synopses.current_reservoir(spark, state, counts=True)
            want = samplers.reservoir(seen, 30, "event_id", 6, strata="event_type").select("event_id")
            assert now["reservoir"].count() == want.count() == 150 and now["reservoir"].select("event_id").subtract(want).count() == 0
            exact = {r["event_type"]: r["n"] for r in seen.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).collect()}
            assert {r["event_type"]: r["rows"] for r in now["counts"].collect()} == exact == {r["event_type"]: r["n"] for r in synopses.current_aggregates(spark, sums).collect()}
            got = {r["event_type"]: r for r in synopses.answer(now, [("count", None, "n"), ("avg", "value", "m")], "event_type", intervals=True).collect()}
            assert {t: r["n"] for t, r in got.items()} == exact and all(r["m_lower"] < r["m"] < r["m_upper"] for r in got.values())
            assert len(synopses._versions(spark, f"{state}/reservoir")) <= synopses.RETAIN and len(synopses._versions(spark, sums)) <= synopses.RETAIN
    finally:
        q.stop()
        a.stop()
    assert set(list_scratch(spark, state)) == {"_checkpoint", "reservoir", "counts"}


def test_a_half_written_version_is_not_read(spark, events):
    from approxspark.session import drop_scratch, scratch_path

    out = scratch_path(spark, "t-half")
    for v in range(3):
        events.select("event_id").limit(v + 1).write.parquet(f"{out}/batch={v}")
    assert synopses.current(spark, out) == 2
    drop_scratch(spark, f"{out}/batch=2/_SUCCESS")
    assert synopses.current(spark, out) == 1 and synopses.current_aggregates(spark, out).count() == 2
    synopses._retire(spark, 3, 1, out)  # never fewer than two: a replayed batch starts from the one before
    assert synopses._versions(spark, out) == [2]


def test_weighted_reservoir_resumes_and_refuses_strata(spark, events):
    from approxspark.operators import samplers
    from approxspark.session import scratch_path

    cols = events.select("event_id", "event_type", "value")
    src, state = scratch_path(spark, "t-wres-src"), scratch_path(spark, "t-wres")
    for part in ("event_id < 3000", "event_id >= 3000"):
        cols.where(part).repartition(2).write.mode("append").parquet(src)
        paths = synopses.reservoir_stream(synopses.stream_source(spark, src, cols.schema), 50, "event_id", 6, "t-wres", path=state, weight="value")
    got, want = spark.read.parquet(paths["reservoir"]), samplers.weighted(cols, 50, "event_id", "value", 6)
    assert got.count() == 50 and got.select("event_id").subtract(want.select("event_id")).count() == 0
    with pytest.raises(ValueError):
        synopses.start_reservoir(synopses.stream_source(spark, src, cols.schema), 5, "event_id", 1, state, strata="event_type", weight="value", availableNow=True)
