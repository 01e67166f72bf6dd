"""Approximate aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import z_value
from ..operators import approximate, samplers
from ..plans.sizing import ACCURACY_MAX_SAMPLE, ACCURACY_MIN_SAMPLE, ACCURACY_Z, ci_z
from ..sources.tables import SALES_SQL, sales, table
from .exact_q import stratified_sample_sql
from . import register, rounded

# the reference's limits of an accuracy-sized sample, which the operators don't impose
REFERENCE_LIMITS = {"min_sample": ACCURACY_MIN_SAMPLE, "max_sample": ACCURACY_MAX_SAMPLE}
FLAGSHIP_AGGS = [("count", None, "count"), ("avg", "price", "avg_price"), ("sum", "price", "sum_price")]


def accuracy_size_sql(accuracy: float, n_sql: str) -> str:
    """SQL of plans.sizing.size_for_accuracy for population ``n_sql``."""
    e = (100 - accuracy) / 100.0
    raw = int(ACCURACY_Z**2 * 0.25 / e**2)
    return f"least({n_sql}, greatest({ACCURACY_MIN_SAMPLE}, least(least({ACCURACY_MAX_SAMPLE}, {n_sql}), {raw})))"


def approx_group_sql(src: str, by: str, key: str, aggs_sql: str, accuracy: float = 95, confidence: int = 95, seed: int = 42) -> str:
    k = f"(SELECT {accuracy_size_sql(accuracy, 'count(*)')} FROM src)"
    sample = stratified_sample_sql(src, by, key, k, seed, rule="min_one")
    z = ci_z(confidence)
    return (
        f"WITH smp AS ({sample}), tot AS (SELECT count(*)::BIGINT AS total_size FROM ({src})) "
        f"SELECT {by}, {aggs_sql}, count(*) < any_value(pop_n) AS approx, CASE WHEN count(*) >= any_value(pop_n) THEN 0.0::DOUBLE ELSE round({z} / sqrt(count(*)), 6) END AS ci, count(*)::BIGINT AS sample_size, "
        f"any_value(total_size) AS total_size FROM smp, tot GROUP BY {by}"
    )


FLAGSHIP_AGGS_SQL = (
    "any_value(pop_n)::BIGINT AS count, round(avg(price), 4) AS avg_price, "
    "round(sum(price) * any_value(pop_n) / any_value(take_n), 2) AS sum_price"
)


def flagship(spark, d):
    """The reference's "Complex" query, approximately: category, COUNT(*), AVG(price), SUM(price)
    FROM sales GROUP BY category WITH ACCURACY 95% WITHIN 95% CONFIDENCE."""
    res = approximate.approx_agg(sales(spark, d), FLAGSHIP_AGGS, by="category", accuracy=95, confidence=95, key="id", seed=42, **REFERENCE_LIMITS)
    return rounded(res, avg_price=4, sum_price=2, ci=6)


register("flagship_approx_agg", approx_group_sql(f"SELECT * FROM {SALES_SQL}", "category", "id", FLAGSHIP_AGGS_SQL))(flagship)


from ..functions.keys import sql_key, sql_priority  # noqa: E402
from .sampling_q import NULL_EVENTS, bottom_k_sql, null_events  # noqa: E402
from ..operators.sketches import cms_bucket_sql  # noqa: E402
from .sketches_q import cms_sql  # noqa: E402
from ..plans.allocation import allocate, strata_sizes  # noqa: E402
from ..plans.sizing import delivered_accuracy, size_for_accuracy, size_for_shape  # noqa: E402
from ..session import store  # noqa: E402

SALES_SRC = f"SELECT * FROM {SALES_SQL}"


register(
    "approx_group_by",
    approx_group_sql(SALES_SRC, "category", "id", "any_value(pop_n)::BIGINT AS count"),
)(lambda spark, d: rounded(approximate.approx_agg(sales(spark, d), [("count", None, "count")], by="category", key="id", **REFERENCE_LIMITS), ci=6))

LI_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
LI_AGGS = [
    ("count", None, "count"),
    ("sum", "l_quantity", "sum_qty"),
    ("avg", "l_extendedprice", "avg_price"),
    ("min", "l_discount", "min_discount"),
    ("max", "l_tax", "max_tax"),
]
LI_AGGS_SQL = (
    "any_value(pop_n)::BIGINT AS count, round(sum(l_quantity) * any_value(pop_n) / any_value(take_n), 2) AS sum_qty, "
    "round(avg(l_extendedprice), 4) AS avg_price, min(l_discount) AS min_discount, max(l_tax) AS max_tax"
)


@register(
    "approx_group_by_complex",
    approx_group_sql("SELECT * FROM lineitem", "l_returnflag", LI_KEY, LI_AGGS_SQL, accuracy=97, confidence=99, seed=3),
)
def approx_group_by_complex(spark, d):
    res = approximate.approx_agg(table(spark, d, "lineitem"), LI_AGGS, by="l_returnflag", accuracy=97, confidence=99, key=LI_KEY, seed=3, **REFERENCE_LIMITS)
    return rounded(res, sum_qty=2, avg_price=4, ci=6)


SRS_1000 = bottom_k_sql(SALES_SRC, "id", 1000, 42)
N_SALES = f"(SELECT count(*) FROM {SALES_SQL})"


@register("sampled_sum", f"SELECT round(sum(price) * {N_SALES} / count(*), 2) AS sum_price FROM ({SRS_1000})")
def sampled_sum(spark, d):
    return rounded(approximate.sampled_scalar(sales(spark, d), [("sum", "price", "sum_price")], 1000, "id", 42), sum_price=2)


@register(
    "sampled_count",
    f"WITH smp AS ({SRS_1000}) SELECT category, floor(count(*) * {N_SALES} / (SELECT count(*) FROM smp))::BIGINT AS count FROM smp GROUP BY category",
)
def sampled_count(spark, d):
    # D10 grouped: n_g x N / n from a simple random sample, truncated to an integer
    return approximate.sampled_scalar(sales(spark, d), [("count", None, "count")], 1000, "id", 42, by="category")


@register(
    "sampled_avg",
    f"SELECT category, round(avg(price), 4) AS avg_price FROM ({SRS_1000}) GROUP BY category",
)
def sampled_avg(spark, d):
    smp = samplers.simple_random(sales(spark, d), 1000, "id", 42)
    return smp.groupBy("category").agg(F.round(F.avg("price"), 4).alias("avg_price"))


@register("sampled_min_max", f"SELECT min(price) AS min_price, max(price) AS max_price FROM ({SRS_1000})")
def sampled_min_max(spark, d):
    return approximate.sampled_scalar(sales(spark, d), [("min", "price", "min_price"), ("max", "price", "max_price")], 1000, "id", 42)


@register(
    "distinct_by_sample_ratio",
    f"SELECT floor(count(DISTINCT user_id) / count(*) * {N_SALES})::BIGINT AS distinct_users FROM ({SRS_1000})",
)
def distinct_by_sample_ratio(spark, d):
    return approximate.sampled_scalar(sales(spark, d), [("count_distinct", "user_id", "distinct_users")], 1000, "id", 42)


@register(
    "sample_plan_by_accuracy",
    f"WITH src AS ({SALES_SRC}), n AS (SELECT {accuracy_size_sql(95, 'count(*)')} AS k, count(*) AS N FROM src) "
    "SELECT category, count(*)::BIGINT AS pop_n, least(count(*), greatest(1, floor(any_value(k) * count(*) / any_value(N))))::BIGINT AS take_n, "
    "any_value(k)::BIGINT AS sample_total FROM src, n GROUP BY category",
)
def sample_plan_by_accuracy(spark, d):
    # D14 as a plan: sizes per group, total from the accuracy target within the reference's limits
    sizes, _ = store(strata_sizes(sales(spark, d), "category"), "sizes")
    k = size_for_accuracy(95, sizes.agg(F.sum("pop_n")).first()[0], ACCURACY_MIN_SAMPLE, ACCURACY_MAX_SAMPLE)
    return allocate(sizes, k, "category", "min_one").select("category", "pop_n", "take_n", F.lit(k).cast("long").alias("sample_total"))


ACCURATE_K = int(ACCURACY_Z**2 * 0.25 / ((100 - 99.9) / 100.0) ** 2)


@register("sample_size_by_accuracy", f"SELECT count(*)::BIGINT AS population, least(count(*), {ACCURATE_K})::BIGINT AS take_n, count(*) <= {ACCURATE_K} AS complete FROM lineitem")
def sample_size_by_accuracy(spark, d):
    # D14 without limits: 99.9 asks for 960,400 rows, and gets them or all there are
    n = table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("population"))
    N = n.first()[0]
    return n.select("population", F.lit(size_for_accuracy(99.9, N)).cast("long").alias("take_n"), F.lit(delivered_accuracy(size_for_accuracy(99.9, N), N) == 100.0).alias("complete"))


SHAPE_K_SQL = "CAST(10000 * 2 * 1.5 * (1 + (0.95 - 0.95) * 4) AS BIGINT)"


@register(
    "sample_plan_by_shape",
    f"WITH n AS (SELECT count(*) AS N FROM lineitem) SELECT l_returnflag, count(*)::BIGINT AS pop_n, "
    f"least(count(*), greatest(1, floor({SHAPE_K_SQL} * count(*) / any_value(N))))::BIGINT AS take_n, "
    f"{SHAPE_K_SQL} AS sample_total FROM lineitem, n GROUP BY l_returnflag",
)
def sample_plan_by_shape(spark, d):
    # Grouped query with three aggregates at target 0.95 -> 10000 x 2 x 1.5
    k = size_for_shape(grouped=True, n_aggregates=3, accuracy_target=0.95)
    plan = allocate(strata_sizes(table(spark, d, "lineitem"), "l_returnflag"), k, "l_returnflag", "min_one")
    return plan.select("l_returnflag", F.col("pop_n").cast("long"), "take_n", F.lit(k).cast("long").alias("sample_total"))


CI_LEVELS = [(90, 1.645), (95, 1.96), (99, 2.576)]


@register(
    "result_ci_by_confidence",
    "WITH smp AS ("
    + stratified_sample_sql(SALES_SRC, "category", "id", f"(SELECT {accuracy_size_sql(95, 'count(*)')} FROM src)", 42, rule="min_one")
    + "), c AS (SELECT category, count(*) AS n FROM smp GROUP BY category) "
    "SELECT category, lvl AS confidence, round(z / sqrt(n), 6) AS ci FROM c, (VALUES "
    + ", ".join(f"({c}, {z})" for c, z in CI_LEVELS)
    + ") AS l(lvl, z)",
)
def result_ci_by_confidence(spark, d):
    # Relative half-width z / sqrt(n_g) per group of the approximate GROUP BY sample
    s = sales(spark, d)
    hist = samplers.histogram(s, "category", "id", 42)
    sizes = samplers.sizes_of(hist, "category")
    k = size_for_accuracy(95, sizes.agg(F.sum("pop_n")).first()[0], ACCURACY_MIN_SAMPLE, ACCURACY_MAX_SAMPLE)
    smp = samplers.from_plan(s, allocate(sizes, k, "category", "min_one"), "category", "id", 42, hist)
    levels = F.array(*[F.struct(F.lit(c).alias("confidence"), F.lit(z).alias("z")) for c, z in CI_LEVELS])
    counts = smp.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("category", "n", F.explode(levels).alias("l")).select(
        "category", F.col("l.confidence").alias("confidence"), F.round(F.col("l.z") / F.sqrt("n"), 6).alias("ci")
    )


SALES_K_SQL = f"(SELECT {accuracy_size_sql(95, 'count(*)')} FROM {SALES_SQL})"


@register(
    "approx_result_envelope",
    f"WITH smp AS ({bottom_k_sql(SALES_SRC, 'id', SALES_K_SQL, 42)}) "
    f"SELECT round(sum(price) * {N_SALES} / count(*), 2) AS sum_price, round(avg(price), 4) AS avg_price, count(*) < {N_SALES} AS approx, "
    f"CASE WHEN count(*) >= {N_SALES} THEN 0.0::DOUBLE ELSE round(1.96 / sqrt(count(*)), 6) END AS ci, count(*)::BIGINT AS sample_size, {N_SALES}::BIGINT AS total_size FROM smp",
)
def approx_result_envelope(spark, d):
    res = approximate.approx_agg(sales(spark, d), [("sum", "price", "sum_price"), ("avg", "price", "avg_price")], key="id", **REFERENCE_LIMITS)
    return rounded(res, sum_price=2, avg_price=4, ci=6)


@register(
    "exact_fallback_small",
    f"SELECT category, count(*)::BIGINT AS count, round(sum(price), 2) AS sum_price, false AS approx, 0.0::DOUBLE AS ci, "
    f"count(*)::BIGINT AS sample_size, {N_SALES}::BIGINT AS total_size FROM {SALES_SQL} GROUP BY category",
)
def exact_fallback_small(spark, d):
    # A sample of as many rows as there are answers exactly, whatever the size of the table
    s = sales(spark, d)
    res = approximate.approx_agg(s, [("count", None, "count"), ("sum", "price", "sum_price")], by="category", sample_size=s.count(), key="id")
    return rounded(res, sum_price=2)


@register("approx_select_rows", bottom_k_sql(SALES_SRC, "id", SALES_K_SQL, 42, "id, price"))
def approx_select_rows(spark, d):
    s = sales(spark, d)
    smp = samplers.sized_random(s, lambda n: size_for_accuracy(95, n, ACCURACY_MIN_SAMPLE, ACCURACY_MAX_SAMPLE), "id", 42)[0]
    return smp.select("id", "price")


@register(
    "approx_agg_from_synopsis",
    approx_group_sql(f"SELECT * FROM {SALES_SQL}", "category", "id", FLAGSHIP_AGGS_SQL),
)
def approx_agg_from_synopsis(spark, d):
    # the reference's GROUP BY path: a stratified sample synopsis built once, queries read it
    from ..operators import synopsis

    path = synopsis.build_stratified_sample(sales(spark, d), "category", "id", accuracy=95, seed=42, name="sales-by-category", **REFERENCE_LIMITS)
    res = approximate.approx_agg_from_sample(spark.read.parquet(path), FLAGSHIP_AGGS, "category", confidence=95, strata="category")
    return rounded(res, avg_price=4, sum_price=2, ci=6)


# stored synopses of sales, answered without the base table
SAMPLE_K = 2000


def sales_synopses(spark, d):
    from ..operators import synopsis

    return synopsis.build_sketches(sales(spark, d), "id", distinct=["user_id"], counts=["category"], strata=["category"], sample_size=SAMPLE_K, seed=42, name="sales-synopses")


SALES_SRS = bottom_k_sql(SALES_SRC, "id", SAMPLE_K, 42)


@register(
    "synopsis_scalars",
    f"SELECT {N_SALES}::BIGINT AS count, round(sum(price) * {N_SALES} / count(*), 0) AS sum_price, round(avg(price), 4) AS avg_price, count(*) < {N_SALES} AS approx, "
    f"CASE WHEN count(*) >= {N_SALES} THEN 0.0::DOUBLE ELSE round(1.96 / sqrt(count(*)), 6) END AS ci, count(*)::BIGINT AS sample_size, {N_SALES}::BIGINT AS total_size FROM ({SALES_SRS})",
)
def synopsis_scalars(spark, d):
    # D9-D11 from the stored sample
    sample = spark.read.parquet(sales_synopses(spark, d)["sample"])
    res = approximate.approx_agg_from_sample(sample, [("count", None, "count"), ("sum", "price", "sum_price"), ("avg", "price", "avg_price")], strata=[])
    return rounded(res, sum_price=0, avg_price=4, ci=6)


@register("synopsis_distinct", f"SELECT count(DISTINCT user_id)::BIGINT AS exact_distinct, true AS within_tolerance FROM {SALES_SQL}")
def synopsis_distinct(spark, d):
    # D2 from the stored HLL sketch, beside the exact count
    from ..operators import synopsis

    est = synopsis.distinct_from_sketch(spark, sales_synopses(spark, d)["hll"], "user_id").first()[0]
    exact = sales(spark, d).agg(F.count_distinct("user_id").cast("long").alias("exact_distinct"))
    return exact.select("exact_distinct", (F.abs(F.lit(est) - F.col("exact_distinct")) <= 0.05 * F.col("exact_distinct")).alias("within_tolerance"))


@register(
    "synopsis_group_counts",
    f"WITH cms AS ({cms_sql(f'SELECT category FROM {SALES_SQL}', 'category')}), keys AS (SELECT DISTINCT category FROM {SALES_SQL}), "
    f"probe AS (SELECT category, r AS depth_row, {cms_bucket_sql('r', 'category')} AS bucket FROM keys, range(5) AS g(r)) "
    "SELECT category, min(cnt)::BIGINT AS count FROM probe JOIN cms USING (depth_row, bucket) GROUP BY category",
)
def synopsis_group_counts(spark, d):
    # D8 from the stored Count-Min table; the keys are those of the stored frequent-items summary
    from ..operators import synopsis

    return synopsis.heavy_counts(spark, sales_synopses(spark, d), "category").withColumnRenamed("key", "category")


@register(
    "synopsis_groups",
    f"SELECT category, any_value(pop_n)::BIGINT AS count, round(avg(price), 4) AS avg_price, count(*)::BIGINT AS sample_size FROM "
    f"(SELECT category, price, count(*) OVER (PARTITION BY category) AS pop_n, row_number() OVER (PARTITION BY category ORDER BY {sql_priority('id', 42)}, {sql_key('id')}) AS rn "
    f"FROM {SALES_SQL}) WHERE rn <= {SAMPLE_K} GROUP BY category",
)
def synopsis_groups(spark, d):
    # D13 from the stored per-value samples
    stored = spark.read.parquet(sales_synopses(spark, d)["stratified"]).where(F.col("strata_column") == "category")
    res = approximate.approx_agg_from_sample(stored, [("count", None, "count"), ("avg", "price", "avg_price")], "strata_value", strata="strata_value")
    return rounded(res, avg_price=4).select(F.col("strata_value").alias("category"), "count", "avg_price", "sample_size")


@register(
    "approx_null_group",
    approx_group_sql(NULL_EVENTS, "kind", "event_id", "any_value(pop_n)::BIGINT AS count, round(avg(value), 4) AS avg_value, round(sum(value) * any_value(pop_n) / any_value(take_n), 2) AS sum_value"),
)
def approx_null_group(spark, d):
    # D13 / D21 with a NULL group, which is a group like any other
    aggs = [("count", None, "count"), ("avg", "value", "avg_value"), ("sum", "value", "sum_value")]
    return rounded(approximate.approx_agg(null_events(spark, d), aggs, by="kind", key="event_id", **REFERENCE_LIMITS), avg_value=4, sum_value=2, ci=6)


@register(
    "allocation_from_profile",
    f"WITH src AS ({SALES_SRC}), n AS (SELECT count(*) AS N FROM src) SELECT category, count(*)::BIGINT AS pop_n, greatest(1, floor(1000 * count(*) / any_value(N)))::BIGINT AS take_n FROM src, n GROUP BY category",
)
def allocation_from_profile(spark, d):
    # a plan whose stratum sizes come from the profile synopsis instead of a pass over the table
    from ..operators import synopsis

    prof = synopsis.build_profile(sales(spark, d), ["category"], "sales-profile")
    return allocate(synopsis.strata_sizes_from_profile(spark, prof, "category"), 1000, "category", "min_one").select("category", "pop_n", "take_n")


# groups and predicates that have nothing to do with the strata
EV_EQUAL = stratified_sample_sql("SELECT * FROM events", "event_type", "event_id", 900, 11, rule="equal")


def domain_sql(smp: str, strata: str, value: str, groups: str | None, where: str, z: float) -> str:
    """Totals, means and intervals of domains of a stratified sample, from each row's value or 0 (its own definition of the variance)."""
    g, of = ("grp", f"({groups})") if groups else ("1", "1")
    return (
        f"WITH smp AS ({smp}), m AS (SELECT *, {of} AS own, coalesce({where}, false) AS ok FROM smp), g AS (SELECT DISTINCT own AS grp FROM m WHERE ok), "
        f"d AS (SELECT grp, {strata} AS h, pop_n, take_n, CASE WHEN ok AND own IS NOT DISTINCT FROM grp THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d, {value} AS x FROM m, g), "
        "t AS (SELECT grp, sum(d * pop_n / take_n) AS c, sum(d * x * pop_n / take_n) AS s, sum(d)::BIGINT AS sample_size, min(x) FILTER (d = 1) AS lo, max(x) FILTER (d = 1) AS hi FROM d GROUP BY grp), "
        "v AS (SELECT grp, h, any_value(pop_n) AS np, any_value(take_n) AS n, var_samp(d) AS vc, var_samp(d * x) AS vs, var_samp(d * (x - s / c)) AS vr FROM d JOIN t USING (grp) GROUP BY grp, h), "
        "e AS (SELECT grp, sum(f * vc) AS vc, sum(f * vs) AS vs, sum(f * vr) AS vr FROM (SELECT *, np * (np - n) / n AS f FROM v) GROUP BY grp) "
        f"SELECT {g} AS grp, floor(round(c, 6))::BIGINT AS count, round(c - {z!r} * sqrt(vc), 4) AS count_lower, round(c + {z!r} * sqrt(vc), 4) AS count_upper, "
        f"round(s, 2) AS total, round(s - {z!r} * sqrt(vs), 2) AS total_lower, round(s + {z!r} * sqrt(vs), 2) AS total_upper, "
        f"round(s / c, 4) AS mean, round(s / c - {z!r} * sqrt(vr) / c, 4) AS mean_lower, round(s / c + {z!r} * sqrt(vr) / c, 4) AS mean_upper, "
        f"lo, hi, sample_size, (SELECT sum(np)::BIGINT FROM (SELECT any_value(pop_n) AS np FROM smp GROUP BY {strata})) AS total_size FROM t JOIN e USING (grp)"
    )


DOMAIN_AGGS = [("count", None, "count"), ("sum", "value", "total"), ("avg", "value", "mean"), ("min", "value", "lo"), ("max", "value", "hi")]


def domain_estimates(sample, by, where, strata):
    res = approximate.estimate(sample, DOMAIN_AGGS, by, strata, where, intervals=True)
    ends = {f"{c}_{e}": n for c, n in (("count", 4), ("total", 2), ("mean", 4)) for e in ("lower", "upper")}
    return rounded(res, total=2, mean=4, **ends).drop("approx", "ci")


@register("sample_any_group", domain_sql(EV_EQUAL, "event_type", "value", "user_id % 7", "value > 20", z_value(0.95)))
def sample_any_group(spark, d):
    # Groups and a predicate other than the strata, each aggregate with its interval
    smp = samplers.stratified(table(spark, d, "events"), 900, "event_type", "event_id", 11, "equal")
    return domain_estimates(smp.withColumn("grp", F.col("user_id") % 7), "grp", "value > 20", "event_type")


@register("sample_where_total", domain_sql(EV_EQUAL, "event_type", "value", None, "user_id < 40 AND event_type <> 'error'", z_value(0.95)))
def sample_where_total(spark, d):
    # B2 over a stored sample: WHERE without GROUP BY
    smp, _ = store(samplers.stratified(table(spark, d, "events"), 900, "event_type", "event_id", 11, "equal"), "events-equal")
    return domain_estimates(smp, None, "user_id < 40 AND event_type <> 'error'", "event_type").withColumn("grp", F.lit(1))


SALES_MIN_ONE = stratified_sample_sql(SALES_SRC, "category", "id", f"(SELECT {accuracy_size_sql(95, 'count(*)')} FROM src)", 42, rule="min_one")


@register("approx_agg_intervals", domain_sql(SALES_MIN_ONE, "category", "price", "category", "true", z_value(0.95)))
def approx_agg_intervals(spark, d):
    # The approximate GROUP BY with an interval beside each aggregate; COUNT of whole strata is exact
    aggs = [("count", None, "count"), ("sum", "price", "total"), ("avg", "price", "mean"), ("min", "price", "lo"), ("max", "price", "hi")]
    res = approximate.approx_agg(sales(spark, d), aggs, by="category", key="id", intervals=True, **REFERENCE_LIMITS)
    ends = {f"{c}_{e}": n for c, n in (("count", 4), ("total", 2), ("mean", 4)) for e in ("lower", "upper")}
    return rounded(res, total=2, mean=4, **ends).drop("approx", "ci").withColumnRenamed("category", "grp")
