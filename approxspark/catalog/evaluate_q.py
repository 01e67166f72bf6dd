"""Accuracy-evaluation queries (H1-H6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import z_value
from ..operators import approximate, bounds, evaluate, samplers
from ..plans.allocation import strata_sizes
from ..plans.sizing import ACCURACY_MAX_SAMPLE, ACCURACY_MIN_SAMPLE, size_for_accuracy
from ..sources.tables import SALES_SQL, sales, table
from .approximate_q import REFERENCE_LIMITS, FLAGSHIP_AGGS, FLAGSHIP_AGGS_SQL, approx_group_sql
from .bounds_q import SRS, bootstrap_sql, mean_bounds_sql, order_stat_sql, shown, stratified_bounds_sql
from .exact_q import stratified_sample_sql
from .sampling_q import bottom_k_sql
from . import register

SALES_SRC = f"SELECT * FROM {SALES_SQL}"
SRS_SALES = bottom_k_sql(SALES_SRC, "id", 1000, 42)


@register(
    "error_scalar",
    f"WITH e AS (SELECT sum(price) AS ex, count(*) AS n FROM {SALES_SQL}), a AS (SELECT sum(price) AS s, count(*) AS k FROM ({SRS_SALES})) "
    "SELECT round(ex, 2) AS exact_sum, round(s * n / k, 2) AS approx_sum, round(abs(ex - s * n / k) / ex * 100, 4) AS error_pct FROM e, a",
)
def error_scalar(spark, d):
    s = sales(spark, d)
    approx = approximate.sampled_scalar(s, [("sum", "price", "approx_sum")], 1000, "id", 42).first()["approx_sum"]
    ex = s.agg(F.sum("price").alias("ex"))
    # the sampled total is a scalar; the exact one is computed over the whole table
    return ex.select(
        F.round("ex", 2).alias("exact_sum"), F.round(F.lit(approx), 2).alias("approx_sum"),
        F.round(evaluate.error_pct(F.col("ex"), F.lit(approx)), 4).alias("error_pct"),
    )


ERR_COLS = ["count", "avg_price", "sum_price"]


@register(
    "error_by_group",
    f"WITH ex AS (SELECT category, count(*)::DOUBLE AS e_count, avg(price) AS e_avg, sum(price) AS e_sum FROM {SALES_SQL} GROUP BY category), "
    f"ap AS (SELECT category, count::DOUBLE AS a_count, avg_price AS a_avg, sum_price AS a_sum FROM ({approx_group_sql(SALES_SRC, 'category', 'id', FLAGSHIP_AGGS_SQL)})), "
    "j AS (SELECT * FROM ex FULL JOIN ap USING (category)), "
    "m AS (SELECT avg(CASE WHEN e_count IS NULL OR a_count IS NULL THEN 100.0 ELSE abs(e_count - a_count) / e_count * 100 END) AS c1, "
    "avg(CASE WHEN e_avg IS NULL OR a_avg IS NULL THEN 100.0 ELSE abs(e_avg - a_avg) / e_avg * 100 END) AS c2, "
    "avg(CASE WHEN e_sum IS NULL OR a_sum IS NULL THEN 100.0 ELSE abs(e_sum - a_sum) / e_sum * 100 END) AS c3 FROM j) "
    "SELECT 'count' AS \"column\", round(c1, 4) AS error_pct FROM m UNION ALL SELECT 'avg_price', round(c2, 4) FROM m "
    "UNION ALL SELECT 'sum_price', round(c3, 4) FROM m UNION ALL SELECT 'overall', round((c1 + c2 + c3) / 3, 4) FROM m",
)
def error_by_group(spark, d):
    s = sales(spark, d)
    ex = s.groupBy("category").agg(F.count(F.lit(1)).alias("count"), F.avg("price").alias("avg_price"), F.sum("price").alias("sum_price"))
    ap = approximate.approx_agg(s, FLAGSHIP_AGGS, by="category", key="id", seed=42, **REFERENCE_LIMITS)
    return evaluate.error_by_group(ex, ap, "category", ERR_COLS)


CONFS = [0.90, 0.95, 0.99]
COVERAGE_SEEDS = list(range(1, 21))


def _coverage_sql() -> str:
    ks = ", ".join(f"({c!r}::DOUBLE, {z_value(c)!r})" for c in CONFS)
    e = "((100.0 - conf * 100.0) / 100.0)"
    acc = f"least(count(*), greatest(1000, least(least(100000, count(*)), floor(1.96::DOUBLE * 1.96::DOUBLE * 0.25 / ({e} * {e}))::BIGINT)))"
    return (
        f"WITH s AS ({SALES_SRC}), truth AS (SELECT avg(price) AS t FROM s), "
        f"cz AS (SELECT conf, z, (SELECT {acc} FROM s) AS k FROM (VALUES {ks}) AS v(conf, z)), "
        f"r AS (SELECT conf, z, k, seed, price, row_number() OVER (PARTITION BY conf, seed ORDER BY md5(CAST(seed AS VARCHAR) || ':' || CAST(id AS VARCHAR)), CAST(id AS VARCHAR)) AS rn "
        f"FROM s, cz, range(1, {len(COVERAGE_SEEDS) + 1}) AS g(seed)), "
        "rep AS (SELECT conf, seed, avg(price) AS est, any_value(z) * stddev_samp(price) / sqrt(count(*)) AS m FROM r WHERE rn <= k GROUP BY conf, seed) "
        "SELECT conf AS confidence, count(*)::BIGINT AS runs, round(avg(CASE WHEN est - m <= t AND t <= est + m THEN 1.0 ELSE 0.0 END), 6) AS interval_coverage, "
        "round(avg(CASE WHEN abs(est - t) / abs(t) <= 1.0 - conf THEN 1.0 ELSE 0.0 END), 6) AS within_error_share, "
        "round(avg(abs(est - t) / abs(t)), 6) AS mean_relative_error FROM rep, truth GROUP BY conf"
    )


@register("ci_coverage", _coverage_sql())
def ci_coverage(spark, d):
    # H3: R seeds x {90, 95, 99}% with the accuracy-sized sample; normal interval for AVG(price)
    s = sales(spark, d).select("id", "price")
    truth = s.agg(F.avg("price")).first()[0]
    smp = samplers.replicates(s, "id", COVERAGE_SEEDS, lambda n: [(c, size_for_accuracy(c * 100, n, ACCURACY_MIN_SAMPLE, ACCURACY_MAX_SAMPLE)) for c in CONFS])
    z = F.element_at(F.create_map(*[x for c in CONFS for x in (F.lit(c), F.lit(z_value(c)))]), F.col("size_label"))
    m = F.first(z) * F.stddev_samp("price") / F.sqrt(F.count(F.lit(1)))
    reps = smp.groupBy("size_label", "seed").agg(F.avg("price").alias("estimate"), m.alias("_m")).select(
        F.col("size_label").alias("confidence"), "estimate", (F.col("estimate") - F.col("_m")).alias("lower_bound"),
        (F.col("estimate") + F.col("_m")).alias("upper_bound"))
    return evaluate.coverage(reps, truth)


SUMMARY_SEEDS = list(range(1, 11))


@register(
    "error_summary",
    f"WITH s AS ({SALES_SRC}), ex AS (SELECT sum(price) AS es, avg(price) AS ea, count(DISTINCT user_id) AS ed, count(*) AS n FROM s), "
    "r AS (SELECT seed, price, user_id, row_number() OVER (PARTITION BY seed ORDER BY md5(CAST(seed AS VARCHAR) || ':' || CAST(id AS VARCHAR)), CAST(id AS VARCHAR)) AS rn "
    f"FROM s, range(1, {len(SUMMARY_SEEDS) + 1}) AS g(seed)), "
    "rep AS (SELECT seed, sum(price) AS ss, avg(price) AS sa, count(DISTINCT user_id) AS sd FROM r WHERE rn <= 1000 GROUP BY seed), "
    "errs AS (SELECT 'sum' AS query, abs(es - ss * n / 1000) / es * 100 AS e FROM rep, ex UNION ALL "
    "SELECT 'avg', abs(ea - sa) / ea * 100 FROM rep, ex UNION ALL "
    "SELECT 'distinct_ratio', abs(ed - floor(sd / 1000 * n)) / ed * 100 FROM rep, ex) "
    "SELECT query, round(avg(e), 2) AS mean_error, round(min(e), 2) AS min_error, round(max(e), 2) AS max_error, count(*)::BIGINT AS runs FROM errs GROUP BY query",
)
def error_summary(spark, d):
    # H4: per query mean / min / max error over seeded replicates
    s = sales(spark, d).select("id", "price", "user_id")
    ex = s.agg(F.sum("price").alias("es"), F.avg("price").alias("ea"), F.count_distinct("user_id").alias("ed"), F.count(F.lit(1)).alias("n")).first()
    N = ex["n"]
    smp = samplers.multi_seed(s, 1000, "id", SUMMARY_SEEDS)
    rep = smp.groupBy("seed").agg(F.sum("price").alias("ss"), F.avg("price").alias("sa"), F.count_distinct("user_id").alias("sd"))
    errs = rep.select(F.explode(F.array(
        F.struct(F.lit("sum").alias("query"), evaluate.error_pct(F.lit(ex["es"]), F.col("ss") * F.lit(N) / F.lit(1000)).alias("error_pct")),
        F.struct(F.lit("avg").alias("query"), evaluate.error_pct(F.lit(ex["ea"]), F.col("sa")).alias("error_pct")),
        F.struct(F.lit("distinct_ratio").alias("query"),
                 evaluate.error_pct(F.lit(ex["ed"]).cast("double"), F.floor(F.col("sd") / F.lit(1000) * F.lit(N)).cast("double")).alias("error_pct")),
    )).alias("r")).select("r.query", "r.error_pct")
    return evaluate.summarize_errors(errs)


def _hist_sql(src: str, label: str, bins: int) -> str:
    return (
        f"(WITH v AS (SELECT value AS x FROM ({src})), st AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n FROM v), "
        f"w AS (SELECT lo, n, CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1.0 END AS width FROM st), "
        f"b AS (SELECT least(floor((x - lo) / width), {bins - 1})::INTEGER AS bin, lo, n, width FROM v, w) "
        f"SELECT '{label}' AS source, bin, round(any_value(lo) + bin * any_value(width), 6) AS bin_start, "
        f"round(count(*) / (any_value(n) * any_value(width)), 10) AS density FROM b GROUP BY bin)"
    )


@register(
    "histogram_density",
    f"SELECT * FROM {_hist_sql('SELECT * FROM events', 'population', 50)} UNION ALL SELECT * FROM {_hist_sql(SRS, 'sample', 30)}",
)
def histogram_density(spark, d):
    ev = table(spark, d, "events")
    smp = samplers.simple_random(ev, 1000, "event_id", 42)
    return evaluate.histogram_density(ev, "value", 50, "population").unionByName(evaluate.histogram_density(smp, "value", 30, "sample"))


EV_STRAT = stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 1000, 42)
CMP_COLS = "method, estimate, lower_bound, upper_bound, margin_of_error"


@register(
    "method_comparison",
    " UNION ALL ".join(
        f"SELECT {CMP_COLS} FROM ({q})"
        for q in [
            mean_bounds_sql(SRS, "value", "normal", 0.95),
            mean_bounds_sql(SRS, "value", "student_t", 0.95),
            order_stat_sql(SRS, "value", 0.95),
            bootstrap_sql(SRS, "value", "event_id", 100, 0.95, 42),
            stratified_bounds_sql("normal", 0.95, EV_STRAT, "value", "event_type", "events"),
        ]
    ),
)
def method_comparison(spark, d):
    # H6: estimate +- margin of each method over the same data
    ev = table(spark, d, "events")
    srs = samplers.simple_random(ev, 1000, "event_id", 42)
    strat = samplers.stratified(ev, 1000, "event_type", "event_id", 42)
    rows = [
        bounds.mean_bounds(srs, "value", "normal", 0.95),
        bounds.mean_bounds(srs, "value", "student_t", 0.95),
        bounds.order_statistic_bounds(srs, "value", 0.95),
        bounds.bootstrap_bounds(srs, "value", "event_id", n_bootstrap=100, confidence=0.95, seed=42),
        bounds.stratified_bounds(strat, "value", "event_type", strata_sizes(ev, "event_type"), "normal", 0.95),
    ]
    out = None
    for r in rows:
        r = shown(r).select("method", "estimate", "lower_bound", "upper_bound", "margin_of_error")
        out = r if out is None else out.unionByName(r)
    return out
