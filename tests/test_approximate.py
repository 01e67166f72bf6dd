"""Approximate GROUP BY on several keys with a predicate, against a brute-force sample."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from approxspark.functions.keys import key_string, priority
from approxspark.operators import approximate
from approxspark.plans.sizing import size_for_accuracy
from approxspark.sources.tables import table
from conftest import SF_CHECK

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
BY = ["l_returnflag", "l_linestatus"]


def test_multi_key_where_matches_brute_force(spark):
    li = table(spark, SF_CHECK, "lineitem")
    where = F.col("l_quantity") > 10
    got = approximate.approx_agg(
        li, [("count", None, "n"), ("sum", "l_quantity", "qty"), ("avg", "l_extendedprice", "price")],
        by=BY, where=where, accuracy=96, key=KEY, seed=5,
    )
    f = li.where(where)
    N = f.count()
    k = size_for_accuracy(96, N)
    sizes = f.groupBy(*BY).agg(F.count(F.lit(1)).alias("pop_n"))
    alloc = sizes.withColumn("take_n", F.least(F.col("pop_n"), F.greatest(F.lit(1), F.floor(F.lit(k) * F.col("pop_n") / F.lit(N)))))
    w = Window.partitionBy(*BY).orderBy(priority(KEY, 5), key_string(KEY))
    smp = f.join(alloc, BY).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= F.col("take_n"))
    want = smp.groupBy(*BY).agg(
        F.max("pop_n").cast("long").alias("n"),
        F.round(F.sum("l_quantity") * F.max("pop_n") / F.max("take_n"), 4).alias("qty"),
        F.round(F.avg("l_extendedprice"), 4).alias("price"),
        F.count(F.lit(1)).cast("long").alias("sample_size"),
    )
    got = got.withColumns({"qty": F.round("qty", 4), "price": F.round("price", 4)})
    cols = BY + ["n", "qty", "price", "sample_size"]
    assert got.select(*cols).subtract(want.select(*cols)).count() == 0
    assert want.select(*cols).subtract(got.select(*cols)).count() == 0
    assert got.agg(F.max("total_size")).first()[0] == N


def test_distinct_comes_from_hll_over_the_filtered_table(spark):
    from approxspark.sources.tables import sales

    s = sales(spark, SF_CHECK)
    where = F.col("price") > 150000
    got = approximate.approx_agg(s, [("count", None, "n"), ("count_distinct", "user_id", "users")], by="category",
                                 where=where, key="id")
    exact = s.where(where).groupBy("category").agg(F.count_distinct("user_id").alias("exact"))
    rows = got.join(exact, "category").collect()
    assert len(rows) == 5
    assert all(abs(r["users"] - r["exact"]) <= 0.05 * r["exact"] for r in rows)


def test_ungrouped_distinct_and_select_rows(spark):
    from approxspark.sources.tables import sales

    s = sales(spark, SF_CHECK)
    r = approximate.approx_agg(s, [("sum", "price", "total"), ("count_distinct", "user_id", "users")], key="id").first()
    exact_users = s.select("user_id").distinct().count()
    assert abs(r["users"] - exact_users) <= 0.05 * exact_users and r["approx"] and r["sample_size"] == 384
    rows = approximate.approx_select(s, ["id", "price"], 300, "id", 3, where=F.col("category") == "BUILDING")
    assert rows.count() == 300 and rows.columns == ["id", "price"]


def test_null_group_is_answered(events):
    rows = events.withColumn("kind", F.expr("nullif(event_type, 'error')"))
    got = {r["kind"]: r for r in approximate.approx_agg(rows, [("count", None, "n"), ("avg", "value", "v")], by="kind", key="event_id").collect()}
    want = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k: r["n"] for k, r in got.items()} == want and None in want
    assert sum(r["n"] for r in got.values()) == got[None]["total_size"] == rows.count()


def test_accuracy_gets_the_rows_that_it_asks_for(spark):
    from approxspark.plans.sizing import delivered_accuracy

    assert size_for_accuracy(99.9, 6 * 10**8) == 960399 or size_for_accuracy(99.9, 6 * 10**8) == 960400
    assert size_for_accuracy(99.9, 600_000) == 600_000 and size_for_accuracy(99.9, 600_000, maximum=100_000) == 100_000
    assert delivered_accuracy(600_000, 600_000) == 100.0 and abs(delivered_accuracy(9604, 10**9) - 99.0) < 1e-6


AGGS = [("count", None, "n"), ("count_col", "value", "k"), ("sum", "value", "s"), ("avg", "value", "m")]


def test_any_group_and_predicate_from_a_stratified_sample(spark, events):
    from approxspark.operators import samplers

    rows = events.withColumn("stratum", F.expr("if(event_id % 50 = 0, 'rare', 'common')"))
    smp = samplers.stratified(rows, 1200, "stratum", "event_id", 4, "equal")
    # totals add up to the table, whatever the groups
    for by in ("event_type", ["event_type", "stratum"], None):
        got = approximate.approx_agg_from_sample(smp, AGGS, by, strata="stratum").collect()
        assert abs(sum(r["n"] for r in got) - 10000) <= len(got) and {r["total_size"] for r in got} == {10000}
    # a predicate: near the truth, and the same as by brute force over the sample's weights
    where = "value > 50 AND event_type <> 'click'"
    got = {r["event_type"]: r for r in approximate.approx_agg_from_sample(smp, AGGS, "event_type", strata="stratum", where=where, intervals=True).collect()}
    for r in rows.where(where).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")).collect():
        g = got[r["event_type"]]
        assert g["n_lower"] - 100 <= r["n"] <= g["n_upper"] + 100 and abs(g["s"] / r["s"] - 1) < 0.4 and g["approx"]
    w = {r["event_type"]: r for r in smp.where(where).groupBy("event_type").agg(F.sum("sampling_weight").alias("w"), F.sum(F.col("sampling_weight") * F.col("value")).alias("s")).collect()}
    assert all(abs(got[t]["s"] / w[t]["s"] - 1) < 1e-9 and got[t]["n"] == int(round(w[t]["w"], 6)) for t in w) and set(w) == set(got)
    # without strata the estimates are the same
    plain = {r["event_type"]: r for r in approximate.approx_agg_from_sample(smp, AGGS, "event_type", where=where).collect()}
    assert all(plain[t]["n"] == got[t]["n"] and abs(plain[t]["m"] / got[t]["m"] - 1) < 1e-9 for t in w)


def test_what_cannot_be_estimated_is_refused(spark, events):
    import pytest
    from approxspark.operators import samplers

    smp = samplers.stratified(events, 500, "event_type", "event_id", 4)
    with pytest.raises(ValueError):
        approximate.estimate(smp, AGGS, "event_type", intervals=True)
    with pytest.raises(ValueError):
        approximate.estimate(smp, [("count_distinct", "user_id", "u")])
    with pytest.raises(Exception, match="take_n rows"):  # filtered beforehand: no longer the sample that its columns tell of
        approximate.estimate(smp.where("value > 50"), AGGS, "event_type", "event_type").collect()
    none = approximate.estimate(smp, AGGS, None, "event_type", "value < -1e9", intervals=True).first()
    assert none["n"] == 0 and none["s"] is None and none["m"] is None and none["total_size"] == 10000
    assert approximate.estimate(smp, AGGS, "event_type", "event_type", "value < -1e9").count() == 0


def test_a_complete_sample_is_exact(spark, events):
    from approxspark.operators import samplers

    smp = samplers.stratified(events, 10**6, "event_type", "event_id", 4)
    got = approximate.estimate(smp, AGGS, "user_id", "event_type", intervals=True)
    want = {r["user_id"]: r for r in events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s")).collect()}
    for r in got.collect():
        assert r["n"] == want[r["user_id"]]["n"] == r["n_lower"] == r["n_upper"] and abs(r["s"] / want[r["user_id"]]["s"] - 1) < 1e-9
        assert not r["approx"] and abs(r["s_upper"] - r["s_lower"]) < 1e-6


def test_intervals_cover_the_truth(spark, events):
    # 200 seeds in one job: a seed's sample is a stratum of its own, or one for each event type
    from approxspark.operators import samplers

    rows = events.select("event_id", "event_type", "value", (F.col("user_id") % 3).alias("third"))
    seeds = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("seed"))
    smp = samplers.from_plan(
        seeds, seeds.groupBy("seed", "event_type").agg(F.count(F.lit(1)).alias("pop_n")).withColumn("take_n", F.when(F.col("event_type") == "click", 150).otherwise(90).cast("long")),
        ["seed", "event_type"], ["seed", "event_id"], 5)
    got = approximate.estimate(smp, AGGS, ["seed", "third"], ["seed", "event_type"], "value > 20", intervals=True).drop("total_size")
    truth = rows.where("value > 20").groupBy("third").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total"), F.avg("value").alias("mean"))
    inside = lambda x, true: F.avg(((F.col(f"{x}_lower") <= F.col(true)) & (F.col(true) <= F.col(f"{x}_upper"))).cast("double")).alias(x)
    share = got.join(truth, "third").agg(F.count(F.lit(1)).alias("runs"), inside("n", "rows"), inside("s", "total"), inside("m", "mean")).first()
    assert share["runs"] == 600 and min(share["n"], share["s"], share["m"]) >= 0.93, share
    whole = approximate.estimate(smp, AGGS, "seed", ["seed", "event_type"], intervals=True)
    t = rows.agg(F.sum("value").alias("total"), F.avg("value").alias("mean")).first()
    share = whole.withColumns({"total": F.lit(t["total"]), "mean": F.lit(t["mean"])}).agg(inside("s", "total"), inside("m", "mean")).first()
    assert min(share) >= 0.93, share
