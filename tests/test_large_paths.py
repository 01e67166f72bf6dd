"""Paths that only trigger at scale, forced on small data: joins without broadcast, sketch merging across parts."""

from pyspark.sql import functions as F

from approxspark.operators import samplers, sketches


def test_stratified_without_broadcast_is_exact(spark, events):
    want = samplers.stratified(events, 600, "user_id", "event_id", 8, "min_one").select("event_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = samplers.stratified(events, 600, "user_id", "event_id", 8, "min_one").select("event_id")
        assert got.count() == want.count() and got.subtract(want).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cms_parts_merge_to_whole(events):
    mid = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    a = sketches.cms_build(events.where(F.col("ts") < mid), "user_id")
    b = sketches.cms_build(events.where(F.col("ts") >= mid), "user_id")
    merged = sketches.cms_merge(a, b)
    whole = sketches.cms_build(events, "user_id")
    assert merged.subtract(whole).count() == 0 and whole.subtract(merged).count() == 0


def test_hll_parts_merge(events):
    parts = sketches.hll_sketches(events, "user_id", "event_type")
    merged = sketches.hll_merge(parts).first()["approx_distinct"]
    exact = events.select("user_id").distinct().count()
    assert abs(merged - exact) <= 0.05 * exact
