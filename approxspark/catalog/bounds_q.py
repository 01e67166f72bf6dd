"""Error-bound queries (F1-F15). Oracles rebuild the same sample in DuckDB and apply the formulas."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.keys import sql_key, sql_priority, sql_uniform
from ..functions.stats import t_quantile_sql, z_value
from ..operators import bounds, samplers
from ..operators.joins import join_keys
from ..plans.allocation import allocate
from ..sources.tables import table
from .exact_q import stratified_sample_sql
from .sampling_q import bottom_k_sql
from . import register, rounded

def shown(df):
    """Bounds rounded as the oracles round theirs."""
    return rounded(df, estimate=4, lower_bound=4, upper_bound=4, margin_of_error=4, relative_error=6)


FINITE_RAW = "NOT isnan(xr) AND abs(xr) < 'Infinity'::DOUBLE"
FINITE = "x IS NOT NULL AND NOT isnan(x) AND abs(x) < 'Infinity'::DOUBLE"


def finish_sql(m: str, by: list[str], est: str, lo: str, hi: str, conf: float, method: str, dist: str | None,
               N: str = "NULL", iters: str = "NULL", extra: str = "") -> str:
    """SELECT text of bounds.finish over a CTE/relation ``m`` with column n."""
    est_f = f"(CASE WHEN n = 0 THEN 0.0 ELSE {est} END)"
    lo_f = f"(CASE WHEN n = 0 THEN 0.0 WHEN n = 1 THEN {est} ELSE {lo} END)"
    hi_f = f"(CASE WHEN n = 0 THEN 0.0 WHEN n = 1 THEN {est} ELSE {hi} END)"
    keys = "".join(f"{b}, " for b in by)
    d = "NULL" if dist is None else f"'{dist}'"
    return (
        f"SELECT {keys}round({est_f}, 4) AS estimate, round({lo_f}, 4) AS lower_bound, round({hi_f}, 4) AS upper_bound, "
        f"{float(conf)!r}::DOUBLE AS confidence_level, n::BIGINT AS sample_size, ({N})::BIGINT AS population_size, '{method}' AS method, "
        f"{d}::VARCHAR AS distribution_type, ({iters})::BIGINT AS n_iterations, round(({hi_f} - {lo_f}) / 2, 4) AS margin_of_error, "
        f"CASE WHEN {est_f} = 0 THEN 'Infinity'::DOUBLE ELSE round(({hi_f} - {lo_f}) / 2 / abs({est_f}), 6) END AS relative_error{extra} "
        f"FROM {m}"
    )


def moments_sql(src: str, value: str, by: list[str] | None = None) -> str:
    by = by or []
    keys = "".join(f"{b}, " for b in by)
    grp = f" GROUP BY {', '.join(by)}" if by else ""
    return (
        f"(SELECT {keys}count(x) AS n, avg(x) AS mean, stddev_samp(x) AS sd FROM "
        f"(SELECT {keys}CASE WHEN {FINITE_RAW} THEN xr END AS x FROM (SELECT *, try_cast({value} AS DOUBLE) AS xr FROM ({src}))){grp})"
    )


def fpc_sql(N: str) -> str:
    return f"(CASE WHEN ({N}) IS NULL THEN 1.0 ELSE sqrt(greatest(({N}) - n, 0) / (CASE WHEN ({N}) - 1 > 0 THEN ({N}) - 1 END)) END)"


def mean_bounds_sql(src: str, value: str, method: str, conf: float, N: str = "NULL", by: list[str] | None = None) -> str:
    crit = repr(z_value(conf)) if method == "normal" else t_quantile_sql(conf, "(n - 1)")
    margin = f"({crit} * sd / sqrt(n) * {fpc_sql(N)})"
    return finish_sql(moments_sql(src, value, by), by or [], "mean", f"mean - {margin}", f"mean + {margin}", conf, method,
                      bounds.DISTRIBUTION[method], N)


SRS = bottom_k_sql("SELECT * FROM events", "event_id", 1000, 42)
N_EVENTS = "(SELECT count(*) FROM events)"


def _events_srs(spark, d, k=1000, seed=42):
    ev = table(spark, d, "events")
    return samplers.simple_random(ev, k, "event_id", seed)


@register("bounds_normal", mean_bounds_sql(SRS, "value", "normal", 0.95))
def bounds_normal(spark, d):
    return shown(bounds.mean_bounds(_events_srs(spark, d), "value", "normal", 0.95))


@register("bounds_student_t", mean_bounds_sql(bottom_k_sql("SELECT * FROM events", "event_id", 25, 42), "value", "student_t", 0.95))
def bounds_student_t(spark, d):
    return shown(bounds.mean_bounds(_events_srs(spark, d, 25), "value", "student_t", 0.95))


@register(
    "bounds_fpc",
    f"SELECT 'sample' AS part, * FROM ({mean_bounds_sql(SRS, 'value', 'normal', 0.90, N_EVENTS)}) UNION ALL "
    f"SELECT 'census' AS part, * FROM ({mean_bounds_sql('SELECT * FROM events', 'value', 'normal', 0.90, N_EVENTS)})",
)
def bounds_fpc(spark, d):
    # finite population correction; with n = N the margin is 0
    ev = table(spark, d, "events")
    smp, _, N = samplers.sized_random(ev, lambda n: min(n, 1000), "event_id", 42)
    a = bounds.mean_bounds(smp, "value", "normal", 0.90, population=N).select(F.lit("sample").alias("part"), "*")
    b = bounds.mean_bounds(ev, "value", "normal", 0.90, population=N).select(F.lit("census").alias("part"), "*")
    return shown(a.unionByName(b))


def _drawn_sql(key, seed: int) -> str:
    """How often replicate ``b`` draws a row."""
    u = f"substr(md5('{seed}:' || CAST(b // {bounds.PER_DIGEST} AS VARCHAR) || ':' || {sql_key(key)}), CAST(8 * (b % {bounds.PER_DIGEST}) + 1 AS BIGINT), 8)"
    limits = bounds.poisson_limits()
    return "(" + " + ".join(f"CASE WHEN u >= '{x}' THEN 1 ELSE 0 END" for x in limits) + ")", u


def bootstrap_sql(src: str, value: str, key, B: int, conf: float, seed: int, stat: str = "avg(x)", by: list[str] | None = None) -> str:
    """The replicates' rows written out as often as they are drawn, and the statistic over them."""
    alpha, by = (1 - conf) / 2, by or []
    keys, (m, u) = "".join(f"{c}, " for c in by), _drawn_sql(key, seed)
    grp = lambda *more: f" GROUP BY {', '.join([*by, *more])}" if by or more else ""
    on = " AND ".join(["true", *[f"e.{c} IS NOT DISTINCT FROM q.{c}" for c in by]])
    return (
        f"WITH r AS (SELECT * FROM (SELECT *, try_cast({value} AS DOUBLE) AS x FROM ({src})) WHERE {FINITE}), "
        f"e AS (SELECT {keys}count(*) AS n, {stat} AS m FROM r{grp()}), "
        f"draws AS (SELECT {keys}b, x, unnest(range({m})) FROM (SELECT *, {u} AS u FROM r, range({B}) AS g(b))), "
        f"reps AS (SELECT {keys}b, {stat} AS s FROM draws{grp('b')}), "
        f"q AS (SELECT {keys}quantile_cont(s, {alpha!r}) AS lo, quantile_cont(s, {1 - alpha!r}) AS hi FROM reps{grp()}), "
        f"j AS (SELECT e.*, lo, hi FROM e LEFT JOIN q ON {on}) "
        + finish_sql("j", by, "m", "coalesce(lo, m)", "coalesce(hi, m)", conf, "bootstrap", "BOOTSTRAP", "NULL", str(B))
    )


BOOT_SRC = bottom_k_sql("SELECT * FROM events", "event_id", 200, 42)


@register("bounds_bootstrap", bootstrap_sql(BOOT_SRC, "value", "event_id", 200, 0.95, 42))
def bounds_bootstrap(spark, d):
    return shown(bounds.bootstrap_bounds(_events_srs(spark, d, 200), "value", "event_id", n_bootstrap=200, confidence=0.95, seed=42))


@register("bounds_bootstrap_by_group", bootstrap_sql(SRS, "value", "event_id", 200, 0.90, 8, by=["event_type"]))
def bounds_bootstrap_by_group(spark, d):
    # F4 + F15: a bootstrap interval for each group, in one pass over the sample
    return shown(bounds.bootstrap_bounds(_events_srs(spark, d), "value", "event_id", n_bootstrap=200, confidence=0.90, seed=8, by="event_type"))


TRIMMED_SQL = "list_avg(list_sort(list(x))[1 + (count(*) // 10)::BIGINT:(count(*) - count(*) // 10)::BIGINT])"


@register("bounds_bootstrap_trimmed_mean", bootstrap_sql(BOOT_SRC, "value", "event_id", 100, 0.95, 9, stat=TRIMMED_SQL))
def bounds_bootstrap_trimmed_mean(spark, d):
    # The user's own statistic, a function of an array: the mean without the least and the greatest tenth
    def trimmed(x):
        x = np.sort(x)
        k = len(x) // 10
        return x[k : len(x) - k].mean()

    stat = bounds.ArrayStatistic(trimmed)
    return shown(bounds.bootstrap_bounds(_events_srs(spark, d, 200), "value", "event_id", n_bootstrap=100, confidence=0.95, seed=9, estimator=stat))


@register("bounds_bootstrap_median", bootstrap_sql(BOOT_SRC, "value", "event_id", 200, 0.95, 43, stat="median(x)"))
def bounds_bootstrap_median(spark, d):
    # A user estimator (any aggregate Column function)
    return shown(bounds.bootstrap_bounds(_events_srs(spark, d, 200), "value", "event_id", n_bootstrap=200, confidence=0.95, seed=43,
                                   estimator=F.median))


LI_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
LI_STRAT = stratified_sample_sql("SELECT * FROM lineitem", "l_returnflag", LI_KEY, 600, 42)


def stratified_bounds_sql(method: str, conf: float, sample_sql: str = LI_STRAT, value: str = "l_extendedprice",
                          strata: str = "l_returnflag", population: str = "lineitem") -> str:
    crit = repr(z_value(conf)) if method == "normal" else t_quantile_sql(conf, "(min_nh - 1)")
    per = moments_sql(sample_sql, value, [strata])
    return (
        f"WITH per AS {per}, sizes AS (SELECT {strata}, count(*)::DOUBLE AS Nh, sum(count(*)) OVER ()::DOUBLE AS Ntot FROM {population} GROUP BY {strata}), "
        f"j AS (SELECT * FROM per JOIN sizes USING ({strata})), "
        "a AS (SELECT sum(Nh / Ntot * mean) AS est, sum((Nh / Ntot) * (Nh / Ntot) * coalesce(sd * sd, 0.0) / n) AS v, sum(n) AS n, "
        "any_value(Ntot)::BIGINT AS NN, min(n) AS min_nh, sum(CASE WHEN n < 2 THEN 1 ELSE 0 END)::BIGINT AS strata_without_variance FROM j), "
        f"b AS (SELECT *, {crit} * sqrt(v * greatest(NN - n, 0) / (CASE WHEN NN - 1 > 0 THEN NN - 1 END)) AS margin FROM a) "
        + finish_sql("b", [], "est", "est - margin", "est + margin", conf, f"stratified_{method}", bounds.DISTRIBUTION[method], "NN",
                     extra=", strata_without_variance")
    )


def _li_stratified(spark, d, method):
    # one sizes pass serves both the allocation and the stratum weights of the bounds
    li = table(spark, d, "lineitem")
    hist = samplers.histogram(li, "l_returnflag", LI_KEY, 42)
    sizes = samplers.sizes_of(hist, "l_returnflag")
    smp = samplers.from_plan(li, allocate(sizes, 600, "l_returnflag", "proportional"), "l_returnflag", LI_KEY, 42, hist)
    return shown(bounds.stratified_bounds(smp, "l_extendedprice", "l_returnflag", sizes, method, 0.95))


@register("bounds_stratified", stratified_bounds_sql("normal", 0.95))
def bounds_stratified(spark, d):
    return _li_stratified(spark, d, "normal")


@register("bounds_stratified_t", stratified_bounds_sql("student_t", 0.95))
def bounds_stratified_t(spark, d):
    return _li_stratified(spark, d, "student_t")


def order_stat_sql(src: str, value: str, conf: float) -> str:
    alpha = (1 - conf) / 2
    return (
        f"WITH c AS (SELECT x FROM (SELECT try_cast({value} AS DOUBLE) AS x FROM ({src})) WHERE {FINITE}), "
        "r AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS i, count(*) OVER () AS cnt, avg(x) OVER () AS m FROM c), "
        f"a AS (SELECT count(*) AS n, any_value(m) AS m, max(CASE WHEN i = floor(cnt * {alpha!r}) THEN x END) AS lo, "
        f"max(CASE WHEN i = least(ceil(cnt * {1 - alpha!r}), cnt - 1) THEN x END) AS hi FROM r) "
        + finish_sql("a", [], "m", "lo", "hi", conf, "non_parametric", "NON_PARAMETRIC")
    )


@register("bounds_non_parametric", order_stat_sql(SRS, "value", 0.95))
def bounds_non_parametric(spark, d):
    return shown(bounds.order_statistic_bounds(_events_srs(spark, d), "value", 0.95))


def design_sql(src: str, value: str, design: str, conf: float, N: str) -> str:
    z = repr(z_value(conf))
    if design == "cluster":
        margin, dist = f"{z} * sqrt(sd * sd * {bounds.CLUSTER_DESIGN_EFFECT} / n)", "NORMAL"
    elif design == "systematic":
        margin, dist = f"{z} * sqrt(sd * sd * {bounds.SYSTEMATIC_VARIANCE_FACTOR} * {fpc_sql(N)} / n)", "NORMAL"
    else:
        margin, dist = f"{t_quantile_sql(conf, '(n - 1)')} * sd / sqrt(n) * {fpc_sql(N)}", "STUDENT_T"
    return finish_sql(moments_sql(src, value), [], "mean", f"mean - {margin}", f"mean + {margin}", conf, design, dist, N)


CLUSTER_SRC = (
    f"SELECT * FROM events WHERE user_id IN (SELECT user_id FROM ({bottom_k_sql('SELECT DISTINCT user_id FROM events', 'user_id', 10, 42, 'user_id')}))"
)


@register("bounds_cluster", design_sql(CLUSTER_SRC, "value", "cluster", 0.95, N_EVENTS))
def bounds_cluster(spark, d):
    ev = table(spark, d, "events")
    return shown(bounds.design_bounds(samplers.cluster(ev, 10, "user_id", 42), "value", "cluster", 0.95, population=ev.count()))


SYS_SRC = (
    "WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS rnk FROM orders), "
    "n AS (SELECT count(*) AS N, ('0x' || substr(md5('42:start'), 1, 15))::BIGINT % count(*) AS r0 FROM orders), "
    "t AS (SELECT floor((r0 + j * N) / 600)::BIGINT AS rnk FROM n, range(600) AS g(j)) "
    "SELECT o_orderkey, o_totalprice FROM r JOIN t USING (rnk)"
)


@register("bounds_systematic", design_sql(SYS_SRC, "o_totalprice", "systematic", 0.95, "(SELECT count(*) FROM orders)"))
def bounds_systematic(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    smp = samplers.systematic(orders, 600, "o_orderkey", 42, key="o_orderkey")
    return shown(bounds.design_bounds(smp, "o_totalprice", "systematic", 0.95, population=orders.count()))


@register("bounds_reservoir", design_sql(bottom_k_sql("SELECT * FROM events", "event_id", 1000, 11), "value", "reservoir", 0.99, N_EVENTS))
def bounds_reservoir(spark, d):
    ev = table(spark, d, "events")
    smp = samplers.reservoir(ev, 1000, "event_id", 11)
    return shown(bounds.design_bounds(smp, "value", "reservoir", 0.99, population=ev.count()))


SPECIAL_X = (
    "CASE event_type WHEN 'error' THEN 'NaN' WHEN 'signup' THEN 'Infinity' ELSE CAST(value AS {s}) END"
)
DEGEN_SRC = (
    f"SELECT event_type, {SPECIAL_X.format(s='VARCHAR')} AS raw FROM (SELECT event_id, event_type, value, row_number() OVER "
    f"(PARTITION BY event_type ORDER BY md5('9:' || CAST(event_id AS VARCHAR)), CAST(event_id AS VARCHAR)) AS rn FROM events) WHERE rn <= 1"
)


@register("bounds_degenerate", mean_bounds_sql(DEGEN_SRC, "raw", "student_t", 0.95, by=["event_type"]))
def bounds_degenerate(spark, d):
    # one row per stratum (bottom-1 reservoir); NaN / Inf strata have no finite value
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    one = samplers.reservoir(ev, 1, "event_id", 9, strata="event_type")
    raw = one.select("event_type", F.expr(SPECIAL_X.format(s="STRING")).alias("raw"))
    return shown(bounds.mean_bounds(raw, "raw", "student_t", 0.95, by="event_type"))


ZERO_SRC = f"SELECT event_type, CASE WHEN event_type = 'purchase' THEN 0.0 ELSE value END AS x0 FROM ({SRS})"


@register("bounds_derived", mean_bounds_sql(ZERO_SRC, "x0", "normal", 0.95, by=["event_type"]))
def bounds_derived(spark, d):
    # margin_of_error and relative_error (infinite when the estimate is 0)
    smp = _events_srs(spark, d).select("event_type", F.when(F.col("event_type") == "purchase", F.lit(0.0)).otherwise(F.col("value")).alias("x0"))
    return shown(bounds.mean_bounds(smp, "x0", "normal", 0.95, by="event_type"))


EV_STRAT = stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 1000, 42)


@register("bounds_by_group", mean_bounds_sql(EV_STRAT, "value", "student_t", 0.95, N="pop_n", by=["event_type", "pop_n"]))
def bounds_by_group(spark, d):
    # one bounds row per group, each with its own population size
    smp = samplers.stratified(table(spark, d, "events"), 1000, "event_type", "event_id", 42)
    return shown(bounds.mean_bounds(smp, "value", "student_t", 0.95, population="pop_n", by=["event_type", "pop_n"]))


@register(
    "bounds_validate",
    "SELECT *, (confidence_level > 0 AND confidence_level < 1 AND sample_size >= 0 AND (population_size IS NULL OR population_size >= sample_size) "
    "AND lower_bound <= estimate AND estimate <= upper_bound) AS valid FROM ("
    + f"SELECT * FROM ({order_stat_sql(SRS, 'value', 0.95)}) UNION ALL SELECT * FROM ({mean_bounds_sql(SRS, 'value', 'normal', 0.95, N_EVENTS)})"
    + ")",
)
def bounds_validate(spark, d):
    ev = table(spark, d, "events")
    smp, _, N = samplers.sized_random(ev, lambda n: min(n, 1000), "event_id", 42)
    rows = bounds.order_statistic_bounds(smp, "value", 0.95).unionByName(bounds.mean_bounds(smp, "value", "normal", 0.95, population=N))
    return shown(bounds.validate_rows(rows))


@register(
    "sample_data_facade",
    f"SELECT 'simple' AS sampler, * FROM ({mean_bounds_sql(bottom_k_sql('SELECT * FROM events', 'event_id', 800, 5), 'value', 'student_t', 0.99, N_EVENTS)})",
)
def sample_data_facade(spark, d):
    # One call -> (sample, bounds)
    from ..api import sample_data

    _smp, b = sample_data(table(spark, d, "events"), 800, "simple", "value", "event_id", 0.99, "student_t", seed=5)
    return shown(b.select(F.lit("simple").alias("sampler"), "*"))


def stratified_bootstrap_sql(sample_sql: str, value: str, strata: str, key: list[str], population: str, B: int, conf: float, seed: int) -> str:
    alpha, (m, u) = (1 - conf) / 2, _drawn_sql(key, seed)
    return (
        f"WITH r AS (SELECT * FROM (SELECT *, try_cast({value} AS DOUBLE) AS x FROM ({sample_sql})) WHERE {FINITE}), "
        f"sizes AS (SELECT {strata}, count(*)::DOUBLE AS w FROM {population} GROUP BY {strata}), "
        f"draws AS (SELECT {strata}, b, x, unnest(range({m})) FROM (SELECT *, {u} AS u FROM r, range({B}) AS g(b))), "
        f"reps AS (SELECT b, sum(w * a) / sum(w) AS s FROM (SELECT {strata}, b, avg(x) AS a FROM draws GROUP BY ALL) JOIN sizes USING ({strata}) GROUP BY b), "
        f"q AS (SELECT sum(n)::BIGINT AS n, sum(w * a) / sum(w) AS m, sum(w)::BIGINT AS NN, (SELECT quantile_cont(s, {alpha!r}) FROM reps) AS lo, "
        f"(SELECT quantile_cont(s, {1 - alpha!r}) FROM reps) AS hi FROM (SELECT {strata}, count(*) AS n, avg(x) AS a FROM r GROUP BY {strata}) JOIN sizes USING ({strata})) "
        + finish_sql("q", [], "m", "lo", "hi", conf, "stratified_bootstrap", "BOOTSTRAP", "NN", str(B))
    )


@register("bounds_stratified_bootstrap", stratified_bootstrap_sql(LI_STRAT, "l_extendedprice", "l_returnflag", LI_KEY, "lineitem", 100, 0.95, 7))
def bounds_stratified_bootstrap(spark, d):
    # F4 for strata: every replicate redraws within each stratum
    li = table(spark, d, "lineitem")
    hist = samplers.histogram(li, "l_returnflag", LI_KEY, 42)
    sizes = samplers.sizes_of(hist, "l_returnflag")
    smp = samplers.from_plan(li, allocate(sizes, 600, "l_returnflag"), "l_returnflag", LI_KEY, 42, hist)
    return shown(bounds.stratified_bootstrap_bounds(smp, "l_extendedprice", "l_returnflag", sizes, LI_KEY, 100, 0.95, 7))


WEIGHTED_SRC = (
    "WITH w AS (SELECT o_orderkey, o_totalprice, count(*) OVER (PARTITION BY o_orderpriority)::DOUBLE AS wt FROM orders), "
    f"e AS (SELECT *, ln({sql_uniform(sql_priority('o_orderkey', 42))}) / wt AS es_key FROM w) "
    f"SELECT * FROM e ORDER BY es_key DESC, {sql_key('o_orderkey')} LIMIT 300"
)


@register(
    "bounds_weighted",
    f"WITH s AS ({WEIGHTED_SRC}), t AS (SELECT max(-es_key) AS t FROM s), "
    "u AS (SELECT o_totalprice::DOUBLE AS x, 1 - exp(-wt * t) AS p FROM s, t WHERE -es_key < t), "
    "g AS (SELECT sum(x / p) / sum(1 / p) AS m, sum(1 / p) AS h, count(*) AS n FROM u), "
    f"b AS (SELECT any_value(g.n) AS n, any_value(m) AS m, {z_value(0.95)!r} * sqrt(sum((1 - p) / (p * p) * (x - m) * (x - m))) / any_value(h) AS margin FROM u, g) "
    + finish_sql("b", [], "m", "m - margin", "m + margin", 0.95, "weighted", "NORMAL", "(SELECT count(*) FROM orders)"),
)
def bounds_weighted(spark, d):
    # The mean of a weighted sample by inverse inclusion probability
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    sizes = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).cast("double").alias("wt"))
    smp = samplers.weighted(join_keys(orders, sizes, "o_orderpriority"), 300, "o_orderkey", "wt", 42)
    return shown(bounds.weighted_bounds(smp, "o_totalprice", "wt", 0.95, population=orders.count()))
