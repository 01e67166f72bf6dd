"""Sampler properties (reference: tests/test_sampling.py, tests/test_performance.py)."""

from pyspark.sql import functions as F

from approxspark.operators import samplers
from approxspark.plans.allocation import allocate, strata_sizes


def test_simple_random_exact_size_unique(events):
    s = samplers.simple_random(events, 700, "event_id", 1)
    assert s.count() == 700
    assert s.select("event_id").distinct().count() == 700


def test_simple_random_all_rows_when_k_exceeds_n(events):
    n = events.count()
    assert samplers.simple_random(events, n + 5, "event_id", 1).count() == n


def test_seeds_reproducible_and_different(events):
    a = samplers.simple_random(events, 300, "event_id", 5).select("event_id")
    b = samplers.simple_random(events, 300, "event_id", 5).select("event_id")
    c = samplers.simple_random(events, 300, "event_id", 6).select("event_id")
    assert a.subtract(b).count() == 0
    assert a.subtract(c).count() > 0


def test_simple_random_is_the_exact_bottom_k(events):
    from approxspark.functions.keys import key_string, priority

    for k in (1, 50, 1500, events.count() - 1):
        exact = events.orderBy(priority("event_id", 3), key_string("event_id")).limit(k).select("event_id")
        got = samplers.simple_random(events, k, "event_id", 3).select("event_id")
        assert got.count() == k and exact.subtract(got).count() == 0


def test_allocations_sum_to_k(events):
    sizes = strata_sizes(events, "event_type", "value")
    for rule in ("proportional", "proportional_spread", "equal", "neyman"):
        plan = allocate(sizes, 1003, "event_type", rule)
        assert plan.agg(F.sum("take_n")).first()[0] == 1003, rule


def test_stratified_sizes_and_proportions(events):
    s = samplers.stratified(events, 1000, "event_type", "event_id", 2)
    assert s.count() == 1000
    pop = events.groupBy("event_type").count().withColumn("p", F.col("count") / events.count())
    smp = s.groupBy("event_type").count().withColumn("q", F.col("count") / 1000)
    diffs = pop.join(smp, "event_type").select(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert diffs < 0.1


def test_min_one_keeps_every_group(events):
    s = samplers.stratified(events, 10, "user_id", "event_id", 2, "min_one")
    assert s.select("user_id").distinct().count() == events.select("user_id").distinct().count()


def test_cluster_sample_keeps_whole_clusters(events):
    s = samplers.cluster(events, 7, "user_id", 4)
    chosen = s.select("user_id").distinct()
    assert chosen.count() == 7
    full = events.join(chosen, "user_id", "left_semi").count()
    assert s.count() == full


def test_systematic_exact_size_and_spacing(spark):
    from approxspark.sources.tables import table
    from conftest import SF_CHECK

    orders = table(spark, SF_CHECK, "orders")
    s = samplers.systematic(orders, 600, "o_orderkey", 9)
    rows = sorted(r["_rank"] for r in s.select("_rank").collect())
    assert len(rows) == 600 and len(set(rows)) == 600
    gaps = {b - a for a, b in zip(rows, rows[1:])}
    assert gaps <= {orders.count() // 600, orders.count() // 600 + 1}


def test_reservoir_mergeable(events):
    mid = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    a = samplers.reservoir(events.where(F.col("ts") < mid), 200, "event_id", 8)
    b = samplers.reservoir(events.where(F.col("ts") >= mid), 200, "event_id", 8)
    merged = samplers.reservoir(a.unionByName(b), 200, "event_id", 8).select("event_id")
    whole = samplers.reservoir(events, 200, "event_id", 8).select("event_id")
    assert merged.subtract(whole).count() == 0 and whole.count() == 200


def test_weighted_prefers_heavy_rows(events):
    w = events.withColumn("w", F.when(F.col("event_type") == "purchase", 50.0).otherwise(1.0))
    s = samplers.weighted(w, 200, "event_id", "w", 3)
    assert s.count() == 200
    share = s.where(F.col("event_type") == "purchase").count() / 200
    assert share > 0.5


def test_weighted_ignores_zero_and_nan_weights(events):
    w = events.withColumn("w", F.when(F.col("event_type") == "click", F.lit(float("nan"))).when(F.col("event_type") == "view", 0.0).otherwise(1.0))
    s = samplers.weighted(w, 300, "event_id", "w", 3)
    assert s.where(F.col("event_type").isin("click", "view")).count() == 0


def test_error_margin_required(events):
    import pytest

    with pytest.raises(ValueError):
        samplers.sized(events, "event_id")
    assert samplers.sized(events, "event_id", error_margin=0.05).count() == 370


def test_duplicate_key_check(spark, events):
    from conftest import SF_SMALL
    from approxspark.sources.tables import table

    assert samplers.duplicate_keys(events, "event_id") == 0
    li = table(spark, SF_SMALL, "lineitem")
    assert samplers.duplicate_keys(li, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]) == 1
    assert samplers.duplicate_keys(li, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]) == 0


def test_repeated_and_null_keys_give_exact_sizes(spark, events):
    rows = events.select(F.expr("nullif(event_type, 'error')").alias("kind"), F.expr("if(user_id % 3 = 0, null, user_id % 5)").alias("u"), "value")
    assert samplers.simple_random(rows, 50, "u", 1).count() == 50
    assert samplers.simple_random(rows, 100, ["kind", "u"], 1).count() == 100
    assert samplers.systematic(rows, 50, "u", 1).count() == 50
    assert samplers.weighted(rows.withColumn("w", F.lit(2.0)), 77, "u", "w", 1).count() == 77
    same = spark.range(1000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    assert samplers.simple_random(same, 10, "k", 1).count() == samplers.systematic(same, 10, "k", 1).count() == 10


def test_null_stratum_is_sampled(events):
    rows = events.withColumn("kind", F.expr("nullif(event_type, 'error')"))
    want = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    s = samplers.stratified(rows, 1000, "kind", "event_id", 1)
    got = {r["kind"]: (r["n"], r["p"], r["t"]) for r in s.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("pop_n").alias("p"), F.max("take_n").alias("t")).collect()}
    assert set(got) == set(want) and None in got
    assert all(got[k][0] == got[k][2] and got[k][1] == want[k] for k in want) and sum(v[0] for v in got.values()) == 1000
    assert samplers.reservoir(rows, 7, "event_id", 1, strata="kind").count() == 35
    assert samplers.cluster(rows, 5, "kind", 1).count() == rows.count()


def test_capped_quota_goes_to_other_strata(spark):
    sizes = spark.createDataFrame([("a", 20, 5.0), ("b", 2000, 1.0), (None, 30, 9.0)], "h string, pop_n long, pop_sd double")
    for rule in ("equal", "proportional", "neyman"):
        plan = {r["h"]: r["take_n"] for r in allocate(sizes, 1000, "h", rule).collect()}
        assert sum(plan.values()) == 1000 and plan["a"] <= 20 and plan[None] <= 30, (rule, plan)
    assert {r["h"]: r["take_n"] for r in allocate(sizes, 1000, "h", "equal").collect()} == {"a": 20, "b": 950, None: 30}
    assert sum(r["take_n"] for r in allocate(sizes, 5000, "h", "equal").collect()) == 2050


def test_neyman_by_hand(spark):
    # N s = 100 x 2, 300 x 1, 100 x 5: shares of 1000 are 0.2, 0.3 and 0.5; of 40 rows 8, 12 and 20
    sizes = spark.createDataFrame([("a", 100, 2.0), ("b", 300, 1.0), ("c", 100, 5.0)], "h string, pop_n long, pop_sd double")
    assert {r["h"]: r["take_n"] for r in allocate(sizes, 40, "h", "neyman").collect()} == {"a": 8, "b": 12, "c": 20}


def test_histogram_sizes_and_deviations(events):
    hist = samplers.histogram(events, "event_type", "event_id", 1, "value")
    got = {r["event_type"]: (r["pop_n"], r["pop_sd"]) for r in samplers.sizes_of(hist, "event_type", deviations=True).collect()}
    for r in strata_sizes(events, "event_type", "value").collect():
        assert got[r["event_type"]][0] == r["pop_n"] and abs(got[r["event_type"]][1] / r["pop_sd"] - 1) < 1e-12


def test_two_passes_over_the_base(spark, events):
    # one for the histogram, one for the rows: whatever the quota, a third is never made
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r

    base = spark.createDataFrame(events.select("event_id", "event_type").rdd.mapPartitions(count), "event_id long, event_type string")
    assert samplers.stratified(base, 1000, "event_type", "event_id", 1).count() == 1000
    assert seen.value <= 2 * events.count()


def test_margin_sizes_clusters_and_steps(spark):
    rows = spark.range(2000).select("id", (F.col("id") % 50).alias("c"))
    # 50 clusters at 10%: n0 = 96.04, 96.04 x 50 / (96.04 + 49) = 33.1
    assert samplers.cluster(rows, None, "c", 1, error_margin=0.1).select("c").distinct().count() == 34
    assert samplers.systematic(rows, None, "id", 1, error_margin=0.05).count() == 323
    import pytest

    with pytest.raises(ValueError):
        samplers.cluster(rows, None, "c", 1)
