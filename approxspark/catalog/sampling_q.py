"""Sampler queries (E1-E16). Every sample is reproduced in DuckDB from the same md5 priorities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import sql_key, sql_priority, sql_uniform
from ..functions.stats import z_value
from ..operators import samplers
from ..operators.joins import join_keys
from ..plans.sizing import required_sample_size
from ..sources.tables import table
from .exact_q import stratified_sample_sql
from . import register

N0_95 = z_value(0.95) ** 2 * 0.25  # n0 * m^2 for confidence 0.95


def bottom_k_sql(src: str, key, k, seed: int, cols: str = "*") -> str:
    return f"SELECT {cols} FROM ({src}) ORDER BY {sql_priority(key, seed)}, {sql_key(key)} LIMIT {k}"


EV_COLS = "event_id, user_id, event_type, value"


@register("sample_simple_random", bottom_k_sql("SELECT * FROM events", "event_id", 500, 42, EV_COLS))
def sample_simple_random(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return samplers.simple_random(ev, 500, "event_id", 42).drop("sampling_weight")


@register(
    "sample_by_error_margin",
    f"WITH r AS (SELECT {EV_COLS}, row_number() OVER (ORDER BY {sql_priority('event_id', 42)}, {sql_key('event_id')}) AS rn FROM events), "
    f"need AS (SELECT least(count(*), ceil({N0_95!r} / (0.05 * 0.05) * count(*) / ({N0_95!r} / (0.05 * 0.05) + count(*) - 1))) AS k FROM events) "
    f"SELECT {EV_COLS} FROM r, need WHERE rn <= k",
)
def sample_by_error_margin(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return samplers.sized(ev, "event_id", error_margin=0.05, seed=42).drop("sampling_weight")


@register(
    "sample_plan_by_margin",
    "SELECT event_type, count(*)::BIGINT AS pop_n, "
    f"ceil({N0_95!r} / (0.05 * 0.05) * count(*) / ({N0_95!r} / (0.05 * 0.05) + count(*) - 1))::BIGINT AS take_n, "
    f"ceil({N0_95!r} / (0.05 * 0.05))::BIGINT AS unbounded_n FROM events GROUP BY event_type",
)
def sample_plan_by_margin(spark, d):
    # E3 per stratum: n0 = z^2 0.25 / m^2, n_h = ceil(n0 N_h / (n0 + N_h - 1))
    n0 = N0_95 / (0.05 * 0.05)
    sizes = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("pop_n"))
    return sizes.select(
        "event_type",
        F.col("pop_n").cast("long").alias("pop_n"),
        F.ceil(F.lit(n0) * F.col("pop_n") / (F.lit(n0) + F.col("pop_n") - 1)).cast("long").alias("take_n"),
        F.lit(required_sample_size(0.05)).cast("long").alias("unbounded_n"),
    )


def _strat_cols(sample_sql: str, cols: str) -> str:
    return f"SELECT {cols} FROM ({sample_sql})"


STRAT_OUT = "event_id, event_type, pop_n::BIGINT AS pop_n, take_n::BIGINT AS take_n, round(sampling_weight, 6) AS sampling_weight"


def _strat_spark(df, cols):
    return df.select(*cols, F.col("pop_n").cast("long"), F.col("take_n").cast("long"), F.round("sampling_weight", 6).alias("sampling_weight"))


@register(
    "sample_stratified_proportional",
    _strat_cols(stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 1000, 42), STRAT_OUT),
)
def sample_stratified_proportional(spark, d):
    s = samplers.stratified(table(spark, d, "events"), 1000, "event_type", "event_id", 42, "proportional")
    return _strat_spark(s, ["event_id", "event_type"])


@register(
    "sample_stratified_spread",
    _strat_cols(stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 1003, 42, rule="proportional_spread"), STRAT_OUT),
)
def sample_stratified_spread(spark, d):
    s = samplers.stratified(table(spark, d, "events"), 1003, "event_type", "event_id", 42, "proportional_spread")
    return _strat_spark(s, ["event_id", "event_type"])


LI_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
LI_OUT = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_returnflag, pop_n::BIGINT AS pop_n, take_n::BIGINT AS take_n"


@register(
    "sample_stratified_neyman",
    _strat_cols(
        stratified_sample_sql("SELECT * FROM lineitem", "l_returnflag", LI_KEY, 2000, 42, value="l_extendedprice", rule="neyman"), LI_OUT
    ),
)
def sample_stratified_neyman(spark, d):
    s = samplers.stratified(table(spark, d, "lineitem"), 2000, "l_returnflag", LI_KEY, 42, "neyman", "l_extendedprice")
    return s.select(*LI_KEY, "l_returnflag", F.col("pop_n").cast("long"), F.col("take_n").cast("long"))


@register(
    "sample_stratified_equal",
    _strat_cols(stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 1003, 42, rule="equal"), STRAT_OUT),
)
def sample_stratified_equal(spark, d):
    s = samplers.stratified(table(spark, d, "events"), 1003, "event_type", "event_id", 42, "equal")
    return _strat_spark(s, ["event_id", "event_type"])


# a thousandth of the events is a stratum that can't give its share, at every scale; its values vary a thousandfold
RARE_EVENTS = (
    "SELECT event_id, CASE WHEN event_id % 1000 = 0 THEN 'rare' ELSE event_type END AS kind, "
    "CASE WHEN event_id % 1000 = 0 THEN value * 1000 ELSE value END AS value FROM events"
)


def rare_events(spark, d):
    rare = F.col("event_id") % 1000 == 0
    return table(spark, d, "events").select(
        "event_id", F.when(rare, F.lit("rare")).otherwise(F.col("event_type")).alias("kind"), F.when(rare, F.col("value") * 1000).otherwise(F.col("value")).alias("value"))


RARE_OUT = "event_id, kind, pop_n::BIGINT AS pop_n, take_n::BIGINT AS take_n, round(sampling_weight, 6) AS sampling_weight"


@register("sample_stratified_equal_capped", _strat_cols(stratified_sample_sql(RARE_EVENTS, "kind", "event_id", 905, 42, rule="equal"), RARE_OUT))
def sample_stratified_equal_capped(spark, d):
    return _strat_spark(samplers.stratified(rare_events(spark, d), 905, "kind", "event_id", 42, "equal"), ["event_id", "kind"])


@register("sample_stratified_neyman_capped", _strat_cols(stratified_sample_sql(RARE_EVENTS, "kind", "event_id", 705, 42, value="value", rule="neyman"), RARE_OUT))
def sample_stratified_neyman_capped(spark, d):
    return _strat_spark(samplers.stratified(rare_events(spark, d), 705, "kind", "event_id", 42, "neyman", "value"), ["event_id", "kind"])


@register(
    "sample_group_min_one",
    _strat_cols(
        stratified_sample_sql("SELECT * FROM events", "user_id", "event_id", 100, 42, rule="min_one"),
        "event_id, user_id, pop_n::BIGINT AS pop_n, take_n::BIGINT AS take_n",
    ),
)
def sample_group_min_one(spark, d):
    s = samplers.stratified(table(spark, d, "events"), 100, "user_id", "event_id", 42, "min_one")
    return s.select("event_id", "user_id", F.col("pop_n").cast("long"), F.col("take_n").cast("long"))


WEIGHTED_SQL = (
    "WITH w AS (SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderpriority) AS wt FROM orders) "
    f"SELECT o_orderkey FROM w ORDER BY ln({sql_uniform(sql_priority('o_orderkey', 42))}) / wt DESC, {sql_key('o_orderkey')} LIMIT 300"
)


def _weighted_orders(spark, d):
    # the reference's weight: each row weighs its own group's size (joined, not windowed:
    # a window over a hot group would put a third of the table in one task)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    sizes = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).cast("double").alias("wt"))
    return join_keys(orders, sizes, "o_orderpriority")


@register("sample_weighted", WEIGHTED_SQL)
def sample_weighted(spark, d):
    return samplers.weighted(_weighted_orders(spark, d), 300, "o_orderkey", "wt", 42).select("o_orderkey")


@register("sample_weighted_merged", WEIGHTED_SQL)
def sample_weighted_merged(spark, d):
    # The weighted samples of three parts merge into that of the whole
    orders = _weighted_orders(spark, d)
    parts = [samplers.weighted(orders.where(F.col("o_orderkey") % 3 == i), 300, "o_orderkey", "wt", 42) for i in range(3)]
    return samplers.merge_weighted(300, "o_orderkey", *parts).select("o_orderkey")


@register(
    "sample_cluster",
    f"WITH c AS ({bottom_k_sql('SELECT DISTINCT user_id FROM events', 'user_id', 10, 42, 'user_id')}) "
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM c)",
)
def sample_cluster(spark, d):
    return samplers.cluster(table(spark, d, "events").select("event_id", "user_id"), 10, "user_id", 42)


@register(
    "sample_systematic",
    "WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS rnk FROM orders), "
    "n AS (SELECT count(*) AS N, ('0x' || substr(md5('42:start'), 1, 15))::BIGINT % count(*) AS r0 FROM orders), "
    "t AS (SELECT floor((r0 + j * N) / 600)::BIGINT AS rnk FROM n, range(600) AS g(j)) "
    "SELECT o_orderkey, o_totalprice FROM r JOIN t USING (rnk)",
)
def sample_systematic(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return samplers.systematic(orders, 600, "o_orderkey", 42, key="o_orderkey").select("o_orderkey", "o_totalprice")


@register("sample_reservoir", bottom_k_sql("SELECT * FROM events", "event_id", 1000, 11, "event_id, value"))
def sample_reservoir(spark, d):
    return samplers.reservoir(table(spark, d, "events").select("event_id", "value"), 1000, "event_id", 11)


@register(
    "sample_reservoir_stratified",
    f"SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type "
    f"ORDER BY {sql_priority('event_id', 11)}, {sql_key('event_id')}) AS rn FROM events) WHERE rn <= 50",
)
def sample_reservoir_stratified(spark, d):
    ev = table(spark, d, "events").select("event_id", "event_type")
    return samplers.reservoir(ev, 50, "event_id", 11, strata="event_type")


def _overlap_sql(a: int, b: int, k: int) -> str:
    sa = bottom_k_sql("SELECT event_id FROM events", "event_id", k, a, "event_id")
    sb = bottom_k_sql("SELECT event_id FROM events", "event_id", k, b, "event_id")
    return f"SELECT {a} AS seed_a, {b} AS seed_b, count(*)::BIGINT AS overlap FROM ({sa}) JOIN ({sb}) USING (event_id)"


SEED_PAIRS = [(42, 42), (42, 43), (42, 7)]


@register("sample_reproducible", " UNION ALL ".join(_overlap_sql(a, b, 1000) for a, b in SEED_PAIRS))
def sample_reproducible(spark, d):
    ev = table(spark, d, "events").select("event_id")
    out = None
    for a, b in SEED_PAIRS:
        sa = samplers.simple_random(ev, 1000, "event_id", a).select("event_id")
        sb = samplers.simple_random(ev, 1000, "event_id", b).select("event_id")
        row = sa.join(sb, "event_id").agg(F.count(F.lit(1)).cast("long").alias("overlap")).select(
            F.lit(a).alias("seed_a"), F.lit(b).alias("seed_b"), "overlap"
        )
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "stratum_proportions",
    "WITH pop AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS pop_share FROM events GROUP BY event_type), "
    f"smp AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS sample_share FROM ({stratified_sample_sql('SELECT * FROM events', 'event_type', 'event_id', 200, 5)}) GROUP BY event_type) "
    "SELECT event_type, round(pop_share, 6) AS pop_share, round(sample_share, 6) AS sample_share, "
    "abs(pop_share - sample_share) < 0.1 AS within FROM pop JOIN smp USING (event_type)",
)
def stratum_proportions(spark, d):
    ev = table(spark, d, "events")
    smp = samplers.stratified(ev, 200, "event_type", "event_id", 5)

    def shares(df, name):
        total = df.count()
        c = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("c"))
        return c.select("event_type", (F.col("c") / F.lit(total)).alias(name))

    j = shares(ev, "pop_share").join(shares(smp, "sample_share"), "event_type")
    return j.select(
        "event_type",
        F.round("pop_share", 6).alias("pop_share"),
        F.round("sample_share", 6).alias("sample_share"),
        (F.abs(F.col("pop_share") - F.col("sample_share")) < 0.1).alias("within"),
    )


@register("union_samples", bottom_k_sql("SELECT * FROM events", "event_id", 400, 3, "event_id"))
def union_samples(spark, d):
    # Reservoirs of two batches appended with unionByName; the bottom-k of the union is the
    # bottom-k of everything (merge property)
    ev = table(spark, d, "events").select("event_id", "ts")
    mid = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = samplers.reservoir(ev.where(F.col("ts") < mid), 400, "event_id", 3)
    second = samplers.reservoir(ev.where(F.col("ts") >= mid), 400, "event_id", 3)
    return samplers.reservoir(first.unionByName(second), 400, "event_id", 3).select("event_id")



# samples by keys that repeat or are partly NULL: which of equal keys' rows are drawn isn't said, so the keys are compared
DUP_KEY = ["l_orderkey"]


@register("sample_repeated_key", bottom_k_sql("SELECT * FROM lineitem", DUP_KEY, 50, 42, "l_orderkey"))
def sample_repeated_key(spark, d):
    return samplers.simple_random(table(spark, d, "lineitem"), 50, DUP_KEY, 42).select("l_orderkey")


NULL_EVENTS = "SELECT event_id, user_id, value, nullif(event_type, 'error') AS kind FROM events"


def null_events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "value", F.expr("nullif(event_type, 'error')").alias("kind"))


@register("sample_null_key_part", bottom_k_sql(NULL_EVENTS, ["kind", "user_id"], 100, 42, "kind, user_id"))
def sample_null_key_part(spark, d):
    return samplers.simple_random(null_events(spark, d), 100, ["kind", "user_id"], 42).select("kind", "user_id")


@register(
    "sample_null_stratum",
    f"SELECT event_id, kind, pop_n::BIGINT AS pop_n, take_n::BIGINT AS take_n FROM ({stratified_sample_sql(NULL_EVENTS, 'kind', 'event_id', 1000, 42)})",
)
def sample_null_stratum(spark, d):
    s = samplers.stratified(null_events(spark, d), 1000, "kind", "event_id", 42)
    return s.select("event_id", "kind", F.col("pop_n").cast("long"), F.col("take_n").cast("long"))


@register(
    "sample_reservoir_null_stratum",
    f"SELECT event_id, kind FROM (SELECT event_id, kind, row_number() OVER (PARTITION BY kind ORDER BY {sql_priority('event_id', 11)}, {sql_key('event_id')}) AS rn "
    f"FROM ({NULL_EVENTS})) WHERE rn <= 50",
)
def sample_reservoir_null_stratum(spark, d):
    return samplers.reservoir(null_events(spark, d), 50, "event_id", 11, strata="kind").select("event_id", "kind")


def margin_size_sql(n: str, margin: float) -> str:
    n0 = N0_95 / (margin * margin)
    return f"least({n}, ceil({n0!r} * {n} / ({n0!r} + {n} - 1)))::BIGINT"


@register(
    "sample_cluster_by_margin",
    f"WITH u AS (SELECT DISTINCT user_id FROM events), r AS (SELECT user_id, row_number() OVER (ORDER BY {sql_priority('user_id', 42)}, {sql_key('user_id')}) AS rn FROM u), "
    f"k AS (SELECT {margin_size_sql('count(*)', 0.2)} AS k FROM u) "
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM r, k WHERE rn <= k)",
)
def sample_cluster_by_margin(spark, d):
    return samplers.cluster(table(spark, d, "events").select("event_id", "user_id"), None, "user_id", 42, error_margin=0.2)


@register(
    "sample_systematic_by_margin",
    "WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS rnk FROM orders), "
    f"n AS (SELECT count(*) AS N, {margin_size_sql('count(*)', 0.05)} AS k, ('0x' || substr(md5('42:start'), 1, 15))::BIGINT % count(*) AS r0 FROM orders), "
    "t AS (SELECT ((r0 + j * N) // k)::BIGINT AS rnk FROM n, range((SELECT k FROM n)) AS g(j)) "
    "SELECT o_orderkey, o_totalprice FROM r JOIN t USING (rnk)",
)
def sample_systematic_by_margin(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return samplers.systematic(orders, None, "o_orderkey", 42, error_margin=0.05, key="o_orderkey").select("o_orderkey", "o_totalprice")
