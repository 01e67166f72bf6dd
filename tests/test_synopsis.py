"""Synopses answer like the direct operators."""

import hashlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from approxspark.catalog.approximate_q import FLAGSHIP_AGGS
from approxspark.operators import approximate, samplers, sketches, synopsis
from approxspark.sources.tables import sales
from conftest import SF_CHECK


def test_group_by_from_sample_synopsis_equals_direct(spark):
    s = sales(spark, SF_CHECK)
    direct = approximate.approx_agg(s, FLAGSHIP_AGGS, by="category", key="id", seed=42)
    path = synopsis.build_stratified_sample(s, "category", "id", 95, 42, "t-synopsis")
    stored = approximate.approx_agg_from_sample(spark.read.parquet(path), FLAGSHIP_AGGS, "category", strata="category")
    assert direct.subtract(stored).count() == 0 and stored.subtract(direct).count() == 0


def test_replicates_equal_single_seed_samples(events):
    rep = samplers.replicates(events.select("event_id"), "event_id", [4, 5], [("a", 30), ("b", 70)])
    for seed in (4, 5):
        for label, k in (("a", 30), ("b", 70)):
            got = rep.where((F.col("seed") == seed) & (F.col("size_label") == label)).select("event_id")
            want = samplers.simple_random(events.select("event_id"), k, "event_id", seed).select("event_id")
            assert got.count() == k and got.subtract(want).count() == 0


def test_profile_counts(spark, events):
    p = synopsis.profile(events.select("value", "event_type"), ["event_type"])
    rows = p.where(F.col("kind") == "frequency").agg(F.sum("count")).first()[0]
    assert rows == events.count()
    assert synopsis.count_from_profile(spark, synopsis.build_profile(events, ["event_type"], "t-prof")).first()["count"] == events.count()


def test_profile_sizes_for_numeric_strata(spark, events):
    # the profile stores values as text; sizes are cast back to the stratum column's type
    ev = events.select("event_id", "user_id", F.col("user_id").cast("string").alias("uid"), "value")
    path = synopsis.build_profile(ev, ["uid"], "t-prof-num")
    sizes = synopsis.strata_sizes_from_profile(spark, path, "uid").select(F.col("uid").cast("long").alias("user_id"), "pop_n")
    direct = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("pop_n"))
    assert direct.subtract(sizes).count() == 0 and sizes.subtract(direct).count() == 0


def test_stored_sample_answers_whole_table_aggregates(spark, events):
    # per-value samples weigh their rows: with every row stored, the answers are exact
    paths = synopsis.build_sketches(events, "event_id", ["user_id"], ["event_type"], ["event_type"], sample_size=10**6, name="t-all")
    stored = spark.read.parquet(paths["stratified"])
    aggs = [("count", None, "n"), ("sum", "value", "s"), ("avg", "value", "m"), ("max", "value", "hi")]
    got = approximate.approx_agg_from_sample(stored, aggs).first()
    want = events.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.avg("value").alias("m"), F.max("value").alias("hi")).first()
    assert got["n"] == want["n"] and abs(got["s"] / want["s"] - 1) < 1e-9 and abs(got["m"] / want["m"] - 1) < 1e-9 and got["hi"] == want["hi"]
    assert not got["approx"] and got["ci"] == 0.0


def _seeded_cells(keys, width=2000, depth=5):
    """Count-Min cells by hashlib: the key is hashed once per depth row, 32 bits of 'row:key'."""
    return Counter((r, int(hashlib.md5(f"{r}:{'\\N' if k is None else k}".encode()).hexdigest()[:8], 16) % width) for k in keys for r in range(depth))


def test_cms_build_hashes_each_key_once_per_depth_row(spark, tmp_path):
    from approxspark.catalog import ORACLES, QUERIES, load_all

    load_all()
    keys = [i * i % 97 for i in range(400)] + [None] * 7 + [-5, 2**62]
    spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "event_id long, user_id long").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    want = dict(_seeded_cells(keys))
    got = {(r["depth_row"], r["bucket"]): r["cnt"] for r in QUERIES["cms_build"](spark, str(tmp_path)).collect()}
    assert got == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert {(r, b): n for r, b, n in con.execute(ORACLES["cms_build"]).fetchall()} == want


def test_cms_with_a_digest_per_depth_row_answers_its_keys(spark):
    # narrow, so that cells are shared: the estimate is the least of a key's own cells
    keys = [f"k{i % (i % 40 + 1)}" for i in range(900)] + [None] * 3
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    cells = _seeded_cells(keys, 16, 7)
    built = sketches.cms_build(df, "k", width=16, depth=7, per_digest=1)
    assert {(r["depth_row"], r["bucket"]): r["cnt"] for r in built.collect()} == dict(cells)
    est = {r["k"]: r["estimate"] for r in sketches.cms_estimate(df, "k", built, 16, 7, per_digest=1).collect()}
    assert est == {k: min(cells[c] for c in _seeded_cells([k], 16, 7)) for k in set(keys)}


def test_no_query_leaves_a_cached_frame(spark):
    from approxspark.catalog import QUERIES, load_all
    from conftest import SF_SMALL

    load_all()
    spark.catalog.clearCache()
    for name in ("flagship_approx_agg", "sample_stratified_neyman", "sample_weighted", "bounds_bootstrap", "method_comparison", "ci_coverage", "sample_systematic", "build_sketches"):
        QUERIES[name](spark, SF_SMALL).collect()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0, name
