"""Error-bound properties (reference: tests/test_error_bounds.py, tests/test_special_cases.py)."""

from pyspark.sql import functions as F

from approxspark.operators import bounds, samplers


def _row(df):
    return df.first().asDict()


def test_t_wider_than_normal(events):
    s = samplers.simple_random(events, 30, "event_id", 1)
    n = _row(bounds.mean_bounds(s, "value", "normal"))
    t = _row(bounds.mean_bounds(s, "value", "student_t"))
    assert t["margin_of_error"] > n["margin_of_error"]
    assert n["lower_bound"] <= n["estimate"] <= n["upper_bound"]


def test_fpc_reduces_margin_and_is_zero_at_census(events):
    N = events.count()
    s = samplers.simple_random(events, 2000, "event_id", 1)
    plain = _row(bounds.mean_bounds(s, "value"))
    fpc = _row(bounds.mean_bounds(s, "value", population=N))
    census = _row(bounds.mean_bounds(events, "value", population=N))
    assert fpc["margin_of_error"] < plain["margin_of_error"]
    assert census["margin_of_error"] == 0.0


def test_bootstrap_reproducible_and_brackets_mean(events):
    s = samplers.simple_random(events, 150, "event_id", 1)
    a = _row(bounds.bootstrap_bounds(s, "value", "event_id", 100, 0.95, 7))
    b = _row(bounds.bootstrap_bounds(s, "value", "event_id", 100, 0.95, 7))
    assert a == b
    assert a["lower_bound"] < a["estimate"] < a["upper_bound"] and a["n_iterations"] == 100


def test_custom_estimator_median(events):
    s = samplers.simple_random(events, 150, "event_id", 1)
    r = _row(bounds.bootstrap_bounds(s, "value", "event_id", 50, 0.9, 7, estimator=F.median))
    assert r["estimate"] == s.agg(F.median("value")).first()[0]
    assert r["lower_bound"] <= r["estimate"] <= r["upper_bound"]


def test_degenerate_inputs(spark):
    # edge values as in the reference fixtures: none finite, one value, mixed specials
    df = spark.createDataFrame(
        [("none", float("nan")), ("none", float("inf")), ("one", 42.0), ("mix", 1.0), ("mix", float("nan")),
         ("mix", 2.0), ("mix", float("inf")), ("mix", 3.0), ("mix", float("-inf"))],
        "g string, value double",
    )
    rows = {r["g"]: r.asDict() for r in bounds.mean_bounds(df, "value", "student_t", by="g").collect()}
    assert (rows["none"]["estimate"], rows["none"]["lower_bound"], rows["none"]["sample_size"]) == (0.0, 0.0, 0)
    assert rows["none"]["relative_error"] == float("inf")
    assert rows["one"]["lower_bound"] == rows["one"]["upper_bound"] == 42.0
    assert rows["mix"]["sample_size"] == 3 and rows["mix"]["estimate"] == 2.0


def test_extreme_magnitudes_stay_finite(spark):
    vals = [(1e-15,), (1e-14,), (1e-13,)] * 20 + [(1e13,), (1e14,), (1e15,)] * 20
    df = spark.createDataFrame(vals, "value double")
    r = _row(bounds.mean_bounds(df, "value"))
    assert all(abs(r[c]) < float("inf") for c in ("estimate", "lower_bound", "upper_bound"))


def test_tiny_values_keep_their_precision(spark):
    # mean of 1e-15, 1e-14, 1e-13 is 3.7e-14; their sample deviation, twenty times over, is 4.4988e-14
    df = spark.createDataFrame([(1e-15,), (1e-14,), (1e-13,)] * 20, "value double")
    r = _row(bounds.mean_bounds(df, "value"))
    assert abs(r["estimate"] / 3.7e-14 - 1) < 1e-12
    sd = (20 * ((3.6e-14) ** 2 + (2.7e-14) ** 2 + (6.3e-14) ** 2) / 59) ** 0.5
    assert abs(r["margin_of_error"] / (1.959963984540054 * sd / 60**0.5) - 1) < 1e-9 and r["lower_bound"] < r["estimate"] < r["upper_bound"]
    from approxspark.operators import approximate, exact

    e = exact.exact_agg(df, [("sum", "value", "s"), ("avg", "value", "m")]).first()
    assert abs(e["s"] / 2.22e-12 - 1) < 1e-12 and abs(e["m"] / 3.7e-14 - 1) < 1e-12
    a = approximate.approx_agg(df.withColumn("id", F.monotonically_increasing_id()), [("sum", "value", "s"), ("avg", "value", "m")], sample_size=60).first()
    assert abs(a["s"] / 2.22e-12 - 1) < 1e-12 and not a["approx"] and a["ci"] == 0.0


def test_published_t_table():
    # two-sided 95% and 99% critical values as printed in textbooks
    from approxspark.functions.stats import t_value

    for df, t95, t99 in ((1, 12.706, 63.657), (2, 4.303, 9.925), (5, 2.571, 4.032), (10, 2.228, 3.169), (30, 2.042, 2.750), (60, 2.000, 2.660), (120, 1.980, 2.617)):
        assert abs(t_value(0.95, df) - t95) < 6e-4 and abs(t_value(0.99, df) - t99) < 6e-4


def test_t_quantile_column_joins_table_and_series(spark):
    from approxspark.functions.stats import EXACT_T_MAX_DF, t_quantile, t_value

    dfs = [1, 2, 31, EXACT_T_MAX_DF, EXACT_T_MAX_DF + 1, 5000]
    for conf in (0.9, 0.99, 0.9999):
        got = spark.createDataFrame([(d,) for d in dfs], "d long").select("d", t_quantile(conf, "d").alias("t")).collect()
        assert all(abs(r["t"] / t_value(conf, r["d"]) - 1) < 1e-11 for r in got)


def test_stratified_variance_and_fpc_by_hand(spark):
    # strata of 60 and 40; samples 1, 3 and 10, 14: mean 0.6 x 2 + 0.4 x 12 = 6, variance
    # (0.36 x 2 / 2 + 0.16 x 8 / 2) x 96 / 99, the finite correction of 4 out of 100
    s = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 10.0), (None, 14.0)], "h string, value double")
    sizes = spark.createDataFrame([("a", 60), (None, 40)], "h string, pop_n long")
    r = _row(bounds.stratified_bounds(s, "value", "h", sizes))
    assert abs(r["estimate"] - 6) < 1e-12
    assert abs(r["margin_of_error"] - 1.959963984540054 * ((0.36 + 0.64) * 96 / 99) ** 0.5) < 1e-9


def test_weighted_bounds_undo_the_weights(events):
    w = events.withColumn("w", F.when(F.col("value") > 60, 20.0).otherwise(1.0))
    truth = events.agg(F.avg("value")).first()[0]
    s = samplers.weighted(w, 1500, "event_id", "w", 3)
    r = _row(bounds.weighted_bounds(s, "value", "w", 0.99, population=events.count()))
    assert r["lower_bound"] <= truth <= r["upper_bound"] and s.agg(F.avg("value")).first()[0] > r["upper_bound"]


def test_stratified_bootstrap_brackets_its_mean(events):
    from approxspark.plans.allocation import strata_sizes

    s = samplers.stratified(events, 200, "event_type", "event_id", 1)
    sizes = strata_sizes(events, "event_type")
    r = _row(bounds.stratified_bootstrap_bounds(s, "value", "event_type", sizes, "event_id", 60))
    plain = _row(bounds.stratified_bounds(s, "value", "event_type", sizes))
    assert r["lower_bound"] < r["estimate"] < r["upper_bound"] and abs(r["estimate"] - plain["estimate"]) < 1e-9


def test_stratified_bounds_and_validate(events):
    from approxspark.plans.allocation import strata_sizes

    s = samplers.stratified(events, 500, "event_type", "event_id", 1)
    r = _row(bounds.stratified_bounds(s, "value", "event_type", strata_sizes(events, "event_type")))
    assert r["lower_bound"] < r["estimate"] < r["upper_bound"] and r["strata_without_variance"] == 0
    v = bounds.validate_rows(bounds.mean_bounds(s, "value", by="event_type")).select(F.min(F.col("valid").cast("int"))).first()[0]
    assert v == 1


def test_coverage_is_near_nominal(spark, events):
    # (c) of the test strategy: a nominal 95% interval covers the true mean in 88-100% of 100 seeds
    from approxspark.operators import evaluate

    truth = events.agg(F.avg("value")).first()[0]
    smp = samplers.multi_seed(events.select("event_id", "value"), 200, "event_id", list(range(100)))
    m = F.lit(1.959963984540054) * F.stddev_samp("value") / F.sqrt(F.count(F.lit(1)))
    reps = smp.groupBy("seed").agg(F.avg("value").alias("estimate"), m.alias("m")).select(
        F.lit(0.95).alias("confidence"), "estimate", (F.col("estimate") - F.col("m")).alias("lower_bound"),
        (F.col("estimate") + F.col("m")).alias("upper_bound"))
    cov = evaluate.coverage(reps, truth).first()
    assert cov["runs"] == 100 and 0.88 <= cov["interval_coverage"] <= 1.0


def test_stratified_bounds_refuses_other_methods(events):
    import pytest

    from approxspark.plans.allocation import strata_sizes

    s = samplers.stratified(events, 200, "event_type", "event_id", 1)
    with pytest.raises(ValueError):
        bounds.stratified_bounds(s, "value", "event_type", strata_sizes(events, "event_type"), "bootstrap")


def test_bootstrap_interval_is_near_the_normal_one(events):
    s = samplers.simple_random(events, 600, "event_id", 3)
    n = _row(bounds.mean_bounds(s, "value"))
    b = _row(bounds.bootstrap_bounds(s, "value", "event_id", 400, 0.95, 5))
    assert abs(b["estimate"] - n["estimate"]) < 1e-9 and abs(b["margin_of_error"] / n["margin_of_error"] - 1) < 0.15


def test_bootstrap_per_group_and_of_an_array_function(spark, events):
    import numpy as np

    s = samplers.simple_random(events, 500, "event_id", 3).withColumn("kind", F.expr("nullif(event_type, 'error')"))
    means = {r["kind"]: r for r in s.groupBy("kind").agg(F.avg("value").alias("m"), F.count("value").alias("n")).collect()}
    by_fn = {r["kind"]: r for r in bounds.bootstrap_bounds(s, "value", "event_id", 60, by="kind", estimator=bounds.ArrayStatistic(np.mean)).collect()}
    for r in bounds.bootstrap_bounds(s, "value", "event_id", 60, by="kind").collect():
        m, f = means[r["kind"]], by_fn[r["kind"]]
        assert abs(r["estimate"] - m["m"]) < 1e-9 and r["sample_size"] == m["n"] and r["lower_bound"] < m["m"] < r["upper_bound"]
        assert all(abs(r[c] - f[c]) < 1e-9 for c in ("estimate", "lower_bound", "upper_bound")) and f["sample_size"] == r["sample_size"]
    assert None in by_fn
    none = _row(bounds.bootstrap_bounds(s.where("value < -1e9"), "value", "event_id", 20))
    assert none["sample_size"] == 0 and none["estimate"] == 0.0
    one = _row(bounds.bootstrap_bounds(s.limit(1), "value", "event_id", 20))
    assert one["lower_bound"] == one["estimate"] == one["upper_bound"]


def test_poisson_multiplicities_have_mean_and_variance_one(spark):
    rows = bounds._digests(spark.range(20_000).select(F.col("id").alias("k")), ["k"], 1, 8)
    m = rows.select(F.explode(F.array(*[bounds._drawn(i) for i in range(bounds.PER_DIGEST)])).alias("m")).agg(F.avg("m").alias("a"), F.variance("m").alias("v")).first()
    assert abs(m["a"] - 1) < 0.02 and abs(m["v"] - 1) < 0.03
