"""Hot strata: one stratum holds half of the table. Results must stay exact and whole, and the
ranked candidate set must stay near the quota (no stratum lands whole in one window task)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from approxspark.functions.keys import key_string, priority
from approxspark.operators import samplers
from approxspark.plans.allocation import allocate, strata_sizes


def _skewed(events):
    # half of all rows relabelled into one hot stratum
    return events.withColumn("stratum", F.when(F.col("event_id") % 2 == 0, F.lit("hot")).otherwise(F.col("event_type")))


def _naive(df, by, key, seed, plan):
    w = Window.partitionBy(by).orderBy(priority(key, seed), key_string(key))
    ranked = df.join(plan.select(by, "take_n"), by).withColumn("rn", F.row_number().over(w))
    return ranked.where(F.col("rn") <= F.col("take_n")).select(key)


def test_hot_stratum_sample_is_exact(events):
    df = _skewed(events)
    plan = allocate(strata_sizes(df, "stratum"), 900, "stratum", "proportional")
    got = samplers.from_plan(df, plan, "stratum", "event_id", 13).select("event_id")
    want = _naive(df, "stratum", "event_id", 13, plan)
    assert got.count() == want.count() == 900
    assert got.subtract(want).count() == 0


def test_only_the_last_bucket_is_ranked(events):
    # of a hot stratum's quota at most about a sixteenth lies in the bucket that is ranked
    df = _skewed(events)
    hist = samplers.histogram(df, "stratum", "event_id", 13).where(F.col("stratum") == "hot").orderBy("_bucket").collect()
    cut, rest = samplers._cut([(r["_bucket"], r["_n"]) for r in hist], 2000)
    below = sum(r["_n"] for r in hist if r["_bucket"] < cut)
    edge = next(r["_n"] for r in hist if r["_bucket"] == cut)
    assert below + rest == 2000 and rest <= edge <= 2000 / 8


def test_hot_group_weighted_and_multi_seed(events):
    df = _skewed(events)
    s = samplers.multi_seed(df.select("event_id", "stratum"), 100, "event_id", [1, 2, 3])
    assert s.groupBy("seed").count().where(F.col("count") != 100).count() == 0
