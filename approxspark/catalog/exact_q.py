"""Sources, projections, filters and exact aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import exact, samplers
from ..sources.tables import SALES_SQL, sales, table
from ..functions.keys import sql_key, sql_priority
from . import register, rounded

SALES = SALES_SQL


@register("sales_view", f"SELECT id, category, price, user_id FROM {SALES}")
def sales_view(spark, d):
    return sales(spark, d)


@register(
    "project_columns",
    f"SELECT category, price FROM {SALES}",
)
def project_columns(spark, d):
    # B1 + B4: identifiers resolve case-insensitively (spark.sql.caseSensitive=false)
    return sales(spark, d).select(F.col("CATEGORY").alias("category"), F.col("Price").alias("price"))


@register(
    "where_filter_agg",
    "SELECT count(*)::BIGINT AS n, round(sum(value), 2) AS total FROM events "
    "WHERE event_type = 'purchase' AND value > 100",
)
def where_filter_agg(spark, d):
    ev = table(spark, d, "events")
    return exact.exact_agg(
        ev, [("count", None, "n"), ("sum", "value", "total")], where=(F.col("event_type") == "purchase") & (F.col("value") > 100)
    ).select("n", F.round("total", 2).alias("total"))


@register(
    "first_per_group",
    f"SELECT category, arg_min(price, id) AS price FROM {SALES} GROUP BY category",
)
def first_per_group(spark, d):
    return exact.first_per_group(sales(spark, d), "category", "price", "id")


_SPECIAL = (
    "CASE event_type WHEN 'error' THEN 'NaN' WHEN 'signup' THEN 'Infinity' WHEN 'view' THEN 'not a number' "
    "WHEN 'click' THEN CAST(-value AS {s}) ELSE CAST(value AS {s}) END"
)


@register(
    "finite_filter",
    "SELECT count(*)::BIGINT AS n, round(sum(x), 2) AS total, min(x) AS lo, max(x) AS hi FROM ("
    f"SELECT try_cast({_SPECIAL.format(s='VARCHAR')} AS DOUBLE) AS x FROM events) "
    "WHERE x IS NOT NULL AND NOT isnan(x) AND abs(x) < 'Infinity'::DOUBLE",
)
def finite_filter(spark, d):
    ev = table(spark, d, "events").select(F.expr(_SPECIAL.format(s="STRING")).alias("raw"))
    clean = exact.finite_values(ev, "raw", "x")
    return clean.agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.round(F.sum("x"), 2).alias("total"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )


@register("distinct_strata", "SELECT DISTINCT event_type FROM events")
def distinct_strata(spark, d):
    return table(spark, d, "events").select("event_type").distinct()


@register("exact_count", f"SELECT count(*)::BIGINT AS count FROM {SALES}")
def exact_count(spark, d):
    return exact.exact_agg(sales(spark, d), [("count", None, "count")])


@register(
    "exact_count_col",
    f"SELECT count(nullif(category, 'BUILDING'))::BIGINT AS count_category FROM {SALES}",
)
def exact_count_col(spark, d):
    s = sales(spark, d).withColumn("category", F.expr("nullif(category, 'BUILDING')"))
    return exact.exact_agg(s, [("count_col", "category", None)])


@register(
    "exact_count_distinct",
    f"SELECT count(DISTINCT user_id)::BIGINT AS count_distinct_user_id FROM {SALES}",
)
def exact_count_distinct(spark, d):
    return exact.exact_agg(sales(spark, d), [("count_distinct", "user_id", None)])


@register("exact_sum", f"SELECT round(sum(price), 2) AS sum_price FROM {SALES}")
def exact_sum(spark, d):
    return exact.exact_agg(sales(spark, d), [("sum", "price", None)]).select(F.round("sum_price", 2).alias("sum_price"))


@register("exact_avg", f"SELECT round(avg(price), 4) AS avg_price FROM {SALES}")
def exact_avg(spark, d):
    return rounded(exact.exact_agg(sales(spark, d), [("avg", "price", None)]), avg_price=4)


@register("exact_min_max", f"SELECT min(price) AS min_price, max(price) AS max_price FROM {SALES}")
def exact_min_max(spark, d):
    return exact.exact_agg(sales(spark, d), [("min", "price", None), ("max", "price", None)])


@register("group_by_count", f"SELECT category, count(*)::BIGINT AS count FROM {SALES} GROUP BY category")
def group_by_count(spark, d):
    return exact.exact_agg(sales(spark, d), [("count", None, None)], by="category")


@register(
    "group_by_multi_key",
    "SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS count, round(sum(l_quantity), 2) AS sum_l_quantity, "
    "round(avg(l_extendedprice), 4) AS avg_l_extendedprice FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def group_by_multi_key(spark, d):
    li = table(spark, d, "lineitem")
    aggs = [("count", None, None), ("sum", "l_quantity", None), ("avg", "l_extendedprice", None)]
    return rounded(exact.exact_agg(li, aggs, by=["l_returnflag", "l_linestatus"]), sum_l_quantity=2, avg_l_extendedprice=4)


@register(
    "group_by_complex",
    f"SELECT category, count(*)::BIGINT AS count, round(avg(price), 4) AS avg_price, round(sum(price), 2) AS sum_price, "
    f"count(DISTINCT user_id)::BIGINT AS count_distinct_user_id, min(price) AS min_price, max(price) AS max_price "
    f"FROM {SALES} GROUP BY category",
)
def group_by_complex(spark, d):
    aggs = [("count", None, None), ("avg", "price", None), ("sum", "price", None), ("count_distinct", "user_id", None),
            ("min", "price", None), ("max", "price", None)]
    return rounded(exact.exact_agg(sales(spark, d), aggs, by="category"), sum_price=2, avg_price=4)


_PROFILE_COLS = ["event_id", "user_id", "value"]


def _profile_sql(cols):
    parts = [
        f"SELECT '{c}' AS \"column\", count({c})::BIGINT AS count, round(avg({c}::DOUBLE), 4) AS mean, "
        f"round(stddev_samp({c}::DOUBLE), 4) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, "
        f"round(sum({c}::DOUBLE), 4) AS sum FROM events"
        for c in cols
    ]
    return " UNION ALL ".join(parts)


@register("numeric_profile", _profile_sql(_PROFILE_COLS))
def numeric_profile(spark, d):
    return rounded(exact.numeric_profile(table(spark, d, "events"), _PROFILE_COLS), mean=4, std=4, sum=4)


@register("value_frequencies", "SELECT event_type, count(*)::BIGINT AS frequency FROM events GROUP BY event_type")
def value_frequencies(spark, d):
    return exact.value_frequencies(table(spark, d, "events"), "event_type")


@register(
    "category_stats",
    f"SELECT category, count(*)::BIGINT AS count, round(avg(price), 4) AS avg_price, round(sum(price), 2) AS sum_price "
    f"FROM {SALES} GROUP BY category",
)
def category_stats(spark, d):
    stats = exact.exact_agg(sales(spark, d), [("count", None, None), ("avg", "price", None), ("sum", "price", None)], by="category")
    return rounded(stats, sum_price=2, avg_price=4)


def stratified_sample_sql(src: str, by: str, key, k, seed: int, value: str | None = None, rule: str = "proportional") -> str:
    """DuckDB text of a stratified bottom-k sample with allocation ``rule`` (as plans.allocation defines it)."""
    prio = sql_priority(key, seed)
    pop_sd = f", stddev_samp({value}) AS pop_sd" if value else ""
    weight = {"equal": "1.0", "neyman": "pop_n * coalesce(pop_sd, 0)"}.get(rule, "pop_n")
    if rule == "min_one":
        plan = f"SELECT {by}, pop_n, least(pop_n, greatest(1, floor({k} * pop_n / sum(pop_n) OVER ()))::BIGINT) AS take_n FROM sizes"
    else:
        order = f"{by}" if rule == "equal" else f"pop_n DESC, {by} DESC"
        # the largest takes what it has room for, the next ones one each; or one each from the start
        most = "least(more, max(CASE WHEN i = 1 THEN pop_n - share END) OVER ())" if rule in ("proportional", "neyman") else "1"
        plan = (
            f"SELECT {by}, pop_n, (share + CASE WHEN is_full OR more <= 0 THEN 0 WHEN i = 1 THEN most WHEN i <= 1 + more - most THEN 1 ELSE 0 END)::BIGINT AS take_n FROM ("
            f"SELECT *, {most} AS most FROM (SELECT *, k - sum(share) OVER () AS more, CASE WHEN NOT is_full THEN row_number() OVER (PARTITION BY is_full ORDER BY {order}) END AS i "
            f"FROM (SELECT *, CASE WHEN is_full THEN pop_n WHEN open_w > 0 THEN floor(rest * w / open_w) ELSE floor(rest * pop_n / open_n) END AS share "
            f"FROM (SELECT *, k - coalesce(sum(pop_n) FILTER (is_full) OVER (), 0) AS rest, sum(w) FILTER (NOT is_full) OVER () AS open_w, sum(pop_n) FILTER (NOT is_full) OVER () AS open_n "
            f"FROM (SELECT *, w > 0 AND coalesce(sum(pop_n) OVER before, 0) + pop_n / w * (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) <= k AS is_full "
            f"FROM (SELECT *, CASE WHEN sum(w0) OVER () > 0 THEN w0 ELSE pop_n END AS w FROM (SELECT *, ({weight})::DOUBLE AS w0, least({k}, sum(pop_n) OVER ()) AS k FROM sizes)) "
            f"WINDOW before AS (ORDER BY CASE WHEN w > 0 THEN pop_n / w END NULLS LAST, {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))))))"
        )
    return (
        f"WITH src AS ({src}), sizes AS (SELECT {by}, count(*) AS pop_n{pop_sd} FROM src GROUP BY {by}), "
        f"plan AS (SELECT * FROM ({plan}) WHERE take_n > 0), "
        f"cand AS (SELECT src.*, plan.pop_n, plan.take_n, row_number() OVER (PARTITION BY src.{by} ORDER BY {prio}, {sql_key(key)}) AS rn "
        f"FROM src JOIN plan ON src.{by} IS NOT DISTINCT FROM plan.{by}) "
        f"SELECT * EXCLUDE (rn), pop_n / take_n AS sampling_weight FROM cand WHERE rn <= take_n"
    )


@register(
    "stratum_summary",
    "WITH pop AS (SELECT event_type, count(*)::BIGINT AS pop_count, round(avg(value), 4) AS pop_mean, round(stddev_samp(value), 4) AS pop_std "
    "FROM events GROUP BY event_type), smp AS (SELECT event_type, count(*)::BIGINT AS sample_count, round(avg(value), 4) AS sample_mean, "
    "round(stddev_samp(value), 4) AS sample_std FROM ("
    + stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 500, 42)
    + ") GROUP BY event_type) SELECT * FROM pop JOIN smp USING (event_type)",
)
def stratum_summary(spark, d):
    ev = table(spark, d, "events")
    smp = samplers.stratified(ev, 500, "event_type", "event_id", 42)
    return rounded(exact.stratum_summary(ev, smp, "event_type", "value"), pop_mean=4, pop_std=4, sample_mean=4, sample_std=4)


@register(
    "merge_on_keys",
    "WITH ex AS (SELECT event_type, count(*)::BIGINT AS exact_count FROM events GROUP BY event_type), "
    "ap AS (SELECT event_type, round(avg(value), 4) AS sample_avg FROM ("
    + stratified_sample_sql("SELECT * FROM events WHERE event_type <> 'error'", "event_type", "event_id", 300, 7)
    + ") GROUP BY event_type) SELECT event_type, exact_count, sample_avg FROM ex LEFT JOIN ap USING (event_type)",
)
def merge_on_keys(spark, d):
    # Exact per-key result merged with an approximate one; the sample misses a key -> left join keeps it
    ev = table(spark, d, "events")
    ex = exact.exact_agg(ev, [("count", None, "exact_count")], by="event_type")
    smp = samplers.stratified(ev.where(F.col("event_type") != "error"), 300, "event_type", "event_id", 7)
    ap = smp.groupBy("event_type").agg(F.round(F.avg("value"), 4).alias("sample_avg"))
    return ex.join(ap, "event_type", "left")
