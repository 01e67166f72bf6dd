"""Streaming queries (A2, G1-G6): each runs a Structured Streaming job over a copy of the table
split into files by its size (PARTS micro-batches, availableNow trigger) and returns the final
state, which must equal the batch answer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.keys import sql_key, sql_priority, sql_uniform
from ..session import scratch_path
from ..sources.tables import table
from ..streaming import synopses
from .sampling_q import bottom_k_sql
from .sketches_q import cms_sql
from . import register

PARTS = 4


def _events_stream(spark, d, name, columns=None):
    ev = table(spark, d, "events")
    if columns:
        ev = ev.select(*columns)
    path, files = synopses.stage_batches(ev, name, order_by="event_id", least=PARTS)
    return synopses.stream_source(spark, path, ev.schema, files_per_trigger=-(-files // PARTS)), ev


@register(
    "stream_append_count",
    "SELECT count(*)::BIGINT AS count, round(sum(value), 2) AS total, round(avg(value), 4) AS mean, true AS multi_batch FROM events",
)
def stream_append_count(spark, d):
    stream, _ = _events_stream(spark, d, "stream-count", ["event_id", "value"])
    aggs = [F.count(F.lit(1)).cast("long").alias("count"), F.sum("value").alias("total"), F.avg("value").alias("mean")]
    final, versions = synopses.run_versioned(synopses.running_aggregates(stream, aggs), "complete", "stream-count-out", retain=None)
    return final.select("count", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"),
                        F.lit(len(versions) >= 3).alias("multi_batch"))


@register(
    "stream_group_agg",
    "SELECT event_type, count(*)::BIGINT AS count, round(sum(value), 2) AS total, round(avg(value), 4) AS mean FROM events GROUP BY event_type",
)
def stream_group_agg(spark, d):
    stream, _ = _events_stream(spark, d, "stream-group", ["event_id", "event_type", "value"])
    aggs = [F.count(F.lit(1)).cast("long").alias("count"), F.sum("value").alias("total"), F.avg("value").alias("mean")]
    final, _ = synopses.run_versioned(synopses.running_aggregates(stream, aggs, "event_type"), "complete", "stream-group-out")
    return final.select("event_type", "count", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"))


@register(
    "stream_hll",
    "SELECT count(DISTINCT user_id)::BIGINT AS exact_distinct, true AS within_tolerance, true AS never_decreases FROM events",
)
def stream_hll(spark, d):
    # The running estimate must track the exact count and grow with new users
    stream, ev = _events_stream(spark, d, "stream-hll", ["event_id", "user_id"])
    final, versions = synopses.run_versioned(synopses.running_hll(stream, "user_id"), "complete", "stream-hll-out", retain=None)
    # all versions in one job, one row each
    out = versions[0].rpartition("/")[0]
    history = spark.read.option("basePath", out).parquet(*versions).withColumn("before", F.lag("approx_distinct").over(Window.orderBy("batch")))
    grows = history.where(F.col("approx_distinct") < F.col("before")).isEmpty()
    exact = ev.agg(F.count_distinct("user_id").cast("long").alias("exact_distinct"))
    est = final.select("approx_distinct").first()[0]
    return exact.select(
        "exact_distinct",
        (F.abs(F.lit(est) - F.col("exact_distinct")) <= F.lit(0.05) * F.col("exact_distinct")).alias("within_tolerance"),
        F.lit(grows).alias("never_decreases"),
    )


@register("stream_cms", cms_sql("SELECT user_id FROM events", "user_id"))
def stream_cms(spark, d):
    stream, _ = _events_stream(spark, d, "stream-cms", ["event_id", "user_id"])
    final, _ = synopses.run_versioned(synopses.running_cms(stream, "user_id"), "complete", "stream-cms-out")
    return final.select(F.col("depth_row").cast("long").alias("depth_row"), "bucket", "cnt")


@register("stream_reservoir", bottom_k_sql("SELECT * FROM events", "event_id", 500, 11, "event_id, value"))
def stream_reservoir(spark, d):
    stream, _ = _events_stream(spark, d, "stream-res", ["event_id", "value"])
    paths = synopses.reservoir_stream(stream, 500, "event_id", 11, "stream-res-out")
    return spark.read.parquet(paths["reservoir"]).select("event_id", "value")


STRAT_RES_SQL = (
    "SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type "
    "ORDER BY md5('11:' || CAST(event_id AS VARCHAR)), CAST(event_id AS VARCHAR)) AS rn FROM events) WHERE rn <= 40"
)


@register("stream_reservoir_stratified", STRAT_RES_SQL)
def stream_reservoir_stratified(spark, d):
    stream, _ = _events_stream(spark, d, "stream-sres", ["event_id", "event_type"])
    paths = synopses.reservoir_stream(stream, 40, "event_id", 11, "stream-sres-out", strata="event_type")
    return spark.read.parquet(paths["reservoir"]).select("event_id", "event_type")


@register(
    "stream_then_query",
    "WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY md5('11:' || CAST(event_id AS VARCHAR)), "
    "CAST(event_id AS VARCHAR)) AS rn FROM events), smp AS (SELECT event_type, round(avg(value), 4) AS approx_avg, count(*)::BIGINT AS sample_size "
    "FROM r WHERE rn <= 40 GROUP BY event_type), c AS (SELECT event_type, count(*)::BIGINT AS count FROM events GROUP BY event_type) "
    "SELECT * FROM c JOIN smp USING (event_type)",
)
def stream_then_query(spark, d):
    # After the stream, answer from the maintained state: exact running counts per type and
    # the average from the per-type reservoir
    stream, _ = _events_stream(spark, d, "stream-tq", ["event_id", "event_type", "value"])
    paths = synopses.reservoir_stream(stream, 40, "event_id", 11, "stream-tq-out", strata="event_type", counts=True)
    res = spark.read.parquet(paths["reservoir"]).groupBy("event_type").agg(
        F.round(F.avg("value"), 4).alias("approx_avg"), F.count(F.lit(1)).cast("long").alias("sample_size")
    )
    counts = spark.read.parquet(paths["counts"]).select("event_type", F.col("rows").alias("count"))
    return counts.join(res, "event_type")


@register(
    "stream_weighted_reservoir",
    f"SELECT event_id FROM events WHERE value > 0 ORDER BY ln({sql_uniform(sql_priority('event_id', 11))}) / value DESC, {sql_key('event_id')} LIMIT 200",
)
def stream_weighted_reservoir(spark, d):
    # E9 over a stream: each batch's weighted sample merges with the state
    stream, _ = _events_stream(spark, d, "stream-wres", ["event_id", "value"])
    paths = synopses.reservoir_stream(stream, 200, "event_id", 11, "stream-wres-out", weight="value")
    return spark.read.parquet(paths["reservoir"]).select("event_id")


@register(
    "stream_state_domains",
    f"WITH r AS ({STRAT_RES_SQL}), s AS (SELECT event_type, count(*) AS pop_n, least(count(*), 40) AS take_n FROM events GROUP BY event_type) "
    "SELECT user_id % 3 AS third, floor(round(sum(pop_n / take_n), 6))::BIGINT AS count, round(sum(value * pop_n / take_n), 2) AS total, count(*)::BIGINT AS sample_size, "
    "(SELECT count(*) FROM events)::BIGINT AS total_size FROM r JOIN events USING (event_id, event_type) JOIN s USING (event_type) GROUP BY 1",
)
def stream_state_domains(spark, d):
    # G6 + D13: groups other than the strata, from the state of the stream
    stream, _ = _events_stream(spark, d, "stream-dom", ["event_id", "event_type", "user_id", "value"])
    path = scratch_path(spark, "stream-dom-out")
    synopses.reservoir_stream(stream, 40, "event_id", 11, "stream-dom", strata="event_type", counts=True, path=path)
    state = synopses.current_reservoir(spark, path, counts=True)
    state["reservoir"] = state["reservoir"].withColumn("third", F.col("user_id") % 3)
    res = synopses.answer(state, [("count", None, "count"), ("sum", "value", "total")], "third")
    return res.select("third", "count", F.round("total", 2).alias("total"), "sample_size", "total_size")
