"""Sketch and synopsis queries (D1-D4, D6-D8, D19, D20, C13 via profile).

HLL estimates are not portable between engines, so their queries return the exact value and a
boolean "estimate within 5%" (the oracle: exact value and TRUE). Count-Min tables are
deterministic (md5 buckets) and checked by value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import sql_key, sql_priority
from ..operators import sketches, synopsis
from ..operators.joins import join_keys
from ..sources.tables import SALES_SQL, sales, table
from .sampling_q import NULL_EVENTS, null_events
from . import register, rounded

TOL = 0.05


def _within(est, exact):
    return (F.abs(est - exact) <= F.lit(TOL) * exact).alias("within_tolerance")


@register(
    "approx_distinct",
    f"SELECT count(DISTINCT user_id)::BIGINT AS exact_distinct, true AS within_tolerance FROM {SALES_SQL}",
)
def approx_distinct(spark, d):
    # the sketch has an aggregate of its own: beside an exact distinct count it would be built per value
    s = sales(spark, d)
    est = sketches.hll_estimate(s, "user_id", alias="est").first()[0]
    return s.agg(F.count_distinct("user_id").cast("long").alias("exact_distinct")).select("exact_distinct", _within(F.lit(est), F.col("exact_distinct")))


@register(
    "approx_distinct_by_group",
    "SELECT event_type, count(DISTINCT user_id)::BIGINT AS exact_distinct, true AS within_tolerance FROM events GROUP BY event_type",
)
def approx_distinct_by_group(spark, d):
    ev = table(spark, d, "events")
    exact = ev.groupBy("event_type").agg(F.count_distinct("user_id").cast("long").alias("exact_distinct"))
    r = join_keys(exact, sketches.hll_estimate(ev, "user_id", "event_type", alias="est"), "event_type")
    return r.select("event_type", "exact_distinct", _within(F.col("est"), F.col("exact_distinct")))


@register(
    "hll_union_parts",
    "SELECT count(DISTINCT l_partkey)::BIGINT AS exact_distinct, count(DISTINCT l_returnflag || l_linestatus)::BIGINT AS parts, "
    "true AS within_tolerance FROM lineitem",
)
def hll_union_parts(spark, d):
    # One sketch per part (here: per return flag / line status batch), merged by union
    li = table(spark, d, "lineitem").withColumn("part", F.concat("l_returnflag", "l_linestatus"))
    parts = sketches.hll_sketches(li, "l_partkey", "part")
    merged = parts.agg(
        F.count(F.lit(1)).alias("parts"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct")
    ).first()
    exact = li.agg(F.count_distinct("l_partkey").cast("long").alias("exact_distinct"))
    return exact.select(
        "exact_distinct", F.lit(merged["parts"]).cast("long").alias("parts"), _within(F.lit(merged["approx_distinct"]), F.col("exact_distinct"))
    )


def cms_sql(src: str, key: str, width: int = sketches.CMS_WIDTH, depth: int = sketches.CMS_DEPTH, per_digest: int = sketches.PER_DIGEST) -> str:
    return (
        f"SELECT r AS depth_row, {sketches.cms_bucket_sql('r', key, width, per_digest)} AS bucket, "
        f"count(*)::BIGINT AS cnt FROM ({src}), range({depth}) AS g(r) GROUP BY 1, 2"
    )


@register("cms_build", cms_sql("SELECT user_id FROM events", "user_id", per_digest=1))
def cms_build(spark, d):
    # D6 as the reference does it: every key is hashed once per depth row, by that row's seed
    return sketches.cms_build(table(spark, d, "events"), "user_id", per_digest=1).select(F.col("depth_row").cast("long").alias("depth_row"), "bucket", "cnt")


@register(
    "cms_point_estimate",
    f"WITH cms AS ({cms_sql('SELECT user_id FROM events', 'user_id')}), "
    "keys AS (SELECT user_id, count(*)::BIGINT AS exact FROM events GROUP BY user_id), "
    f"probe AS (SELECT user_id, exact, r AS depth_row, {sketches.cms_bucket_sql('r', 'user_id')} AS bucket "
    "FROM keys, range(5) AS g(r)) "
    "SELECT user_id, min(cnt)::BIGINT AS estimate, any_value(exact) AS exact, min(cnt) >= any_value(exact) AS never_below "
    "FROM probe JOIN cms USING (depth_row, bucket) GROUP BY user_id",
)
def cms_point_estimate(spark, d):
    ev = table(spark, d, "events")
    cms = sketches.cms_build(ev, "user_id")
    est = sketches.cms_estimate(ev, "user_id", cms)
    exact = ev.groupBy("user_id").agg(F.count(F.lit(1)).cast("long").alias("exact"))
    return est.join(exact, "user_id").select("user_id", "estimate", "exact", (F.col("estimate") >= F.col("exact")).alias("never_below"))


@register(
    "cms_group_counts",
    f"WITH cms AS ({cms_sql(f'SELECT category FROM {SALES_SQL}', 'category')}), "
    f"keys AS (SELECT DISTINCT category FROM {SALES_SQL}), "
    f"probe AS (SELECT category, r AS depth_row, {sketches.cms_bucket_sql('r', 'category')} AS bucket "
    "FROM keys, range(5) AS g(r)) "
    "SELECT category, min(cnt)::BIGINT AS count FROM probe JOIN cms USING (depth_row, bucket) GROUP BY category",
)
def cms_group_counts(spark, d):
    # Grouped COUNT(*) answered by Count-Min lookups of the group keys
    s = sales(spark, d)
    cms = sketches.cms_build(s, "category")
    return sketches.cms_estimate(s, "category", cms, alias="count")


SHARE = 0.02


@register(
    "cms_heavy_groups",
    f"WITH k AS (SELECT nullif(user_id % 20, 3) AS bucket_of FROM events), cms AS ({cms_sql('SELECT * FROM k', 'bucket_of')}), keys AS (SELECT bucket_of, count(*)::BIGINT AS exact FROM k GROUP BY 1), "
    f"probe AS (SELECT bucket_of, exact, r AS depth_row, {sketches.cms_bucket_sql('r', 'bucket_of')} AS bucket FROM keys, range(5) AS g(r)), "
    "est AS (SELECT CAST(bucket_of AS VARCHAR) AS key, min(cnt)::BIGINT AS count, any_value(exact) AS exact FROM probe JOIN cms USING (depth_row, bucket) GROUP BY bucket_of) "
    f"SELECT key, count, count >= exact AS never_below FROM est WHERE exact > {SHARE} * (SELECT count(*) FROM events)",
)
def cms_heavy_groups(spark, d):
    # D8 without the base: the keys come from the stored frequent-items summary, their counts from the stored cells
    ev = table(spark, d, "events").select("event_id", F.nullif(F.col("user_id") % 20, F.lit(3)).alias("bucket_of"))
    paths = synopsis.build_sketches(ev, "event_id", counts=["bucket_of"], sample_size=100, share=SHARE, name="heavy")
    est = synopsis.heavy_counts(spark, paths, "bucket_of", SHARE)
    exact = ev.groupBy(F.col("bucket_of").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("exact"))
    return join_keys(est, exact, "key").where(F.col("exact") > F.lit(SHARE) * F.lit(ev.count())).select("key", "count", (F.col("count") >= F.col("exact")).alias("never_below"))


PROFILE_NUMERIC = ["event_id", "user_id", "value"]


def _profile_oracle() -> str:
    rows = "SELECT '*' AS \"column\", 'rows' AS kind, NULL::VARCHAR AS value, count(*)::BIGINT AS count, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS sum FROM events"
    nums = [
        f"SELECT '{c}', 'numeric', NULL, count({c})::BIGINT, round(avg({c}::DOUBLE), 4), round(stddev_samp({c}::DOUBLE), 4), "
        f"min({c})::DOUBLE, max({c})::DOUBLE, round(sum({c}::DOUBLE), 4) FROM events"
        for c in PROFILE_NUMERIC
    ]
    freq = "SELECT 'event_type', 'frequency', event_type, count(*)::BIGINT, NULL, NULL, NULL, NULL, NULL FROM events GROUP BY event_type"
    return " UNION ALL ".join([rows, *nums, freq])


@register("build_profile", _profile_oracle())
def build_profile(spark, d):
    path = synopsis.build_profile(table(spark, d, "events"), ["event_type"], "profile_events")
    return rounded(spark.read.parquet(path), mean=4, std=4, sum=4)


@register("approx_count_from_profile", "SELECT count(*)::BIGINT AS count, true AS approx, 0.0::DOUBLE AS ci FROM events")
def approx_count_from_profile(spark, d):
    path = synopsis.build_profile(table(spark, d, "events"), ["event_type"], "profile_rows")
    return synopsis.count_from_profile(spark, path)


SKETCH_COLS = ["event_id", "user_id", "event_type", "value"]
SKETCH_K = 1000


@register(
    "build_sketches",
    " UNION ALL ".join(
        [f"SELECT 'hll' AS synopsis, '{c}' AS \"column\", count(DISTINCT CAST({c} AS VARCHAR))::BIGINT AS rows, true AS ok FROM events" for c in SKETCH_COLS]
        + ["SELECT 'cms', 'event_type', 5 * count(*)::BIGINT, true FROM events",
           f"SELECT 'sample', '*', least({SKETCH_K}, count(*))::BIGINT, true FROM events",
           f"SELECT 'stratified', 'event_type', sum(n)::BIGINT, true FROM (SELECT least({SKETCH_K}, count(*)) AS n FROM events GROUP BY event_type)"]),
)
def build_sketches(spark, d):
    # All synopses written once and read back: HLL against exact counts, Count-Min cells against five
    # times the rows, samples against the sizes that they say
    ev = table(spark, d, "events")
    paths = synopsis.build_sketches(ev, "event_id", SKETCH_COLS, ["event_type"], ["event_type"], sample_size=SKETCH_K)
    hll = spark.read.parquet(paths["hll"]).select("column", F.hll_sketch_estimate("sketch").alias("est"))
    exact = ev.agg(*[F.count_distinct(F.col(c).cast("string")).cast("long").alias(c) for c in SKETCH_COLS]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in SKETCH_COLS])).alias("e")
    ).select("e.*")
    out = exact.join(hll, "column").select(F.lit("hll").alias("synopsis"), "column", "rows", _within(F.col("est"), F.col("rows")).alias("ok"))
    cms = spark.read.parquet(paths["cms"]).groupBy("column").agg(F.sum("cnt").alias("rows"), (F.max("bucket") < sketches.CMS_WIDTH).alias("ok"))
    sample = spark.read.parquet(paths["sample"]).agg(F.count(F.lit(1)).alias("rows"), (F.max("take_n") == F.count(F.lit(1))).alias("ok"))
    per = spark.read.parquet(paths["stratified"]).groupBy(F.col("strata_column").alias("column"), "strata_value").agg(F.count(F.lit(1)).alias("rows"), (F.max("take_n") == F.count(F.lit(1))).alias("ok"))
    per = per.groupBy("column").agg(F.sum("rows").alias("rows"), F.bool_and("ok").alias("ok"))
    for name, part in (("cms", cms), ("sample", sample.select(F.lit("*").alias("column"), "*")), ("stratified", per)):
        out = out.unionByName(part.select(F.lit(name).alias("synopsis"), "column", F.col("rows").cast("long").alias("rows"), "ok"))
    return out


@register(
    "cms_null_key",
    f"WITH cms AS ({cms_sql(NULL_EVENTS, 'kind')}), keys AS (SELECT kind, count(*)::BIGINT AS exact FROM ({NULL_EVENTS}) GROUP BY kind), "
    f"probe AS (SELECT kind, exact, r AS depth_row, {sketches.cms_bucket_sql('r', 'kind')} AS bucket FROM keys, range(5) AS g(r)) "
    "SELECT kind, min(cnt)::BIGINT AS count, min(cnt) >= any_value(exact) AS never_below FROM probe JOIN cms USING (depth_row, bucket) GROUP BY kind",
)
def cms_null_key(spark, d):
    # D6-D8 with a NULL key
    ev = null_events(spark, d)
    est = sketches.cms_estimate(ev, "kind", sketches.cms_build(ev, "kind"), alias="count")
    return join_keys(est, ev.groupBy("kind").agg(F.count(F.lit(1)).alias("exact")), "kind").select("kind", "count", (F.col("count") >= F.col("exact")).alias("never_below"))


# synopses of two parts, merged: as if they had been built on both
MERGED_K = 700


def _merged(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    parts = [ev.where(F.col("event_id") % 3 == 0), ev.where(F.col("event_id") % 3 > 0)]
    built = [synopsis.build_sketches(p, "event_id", ["user_id"], ["event_type"], ["event_type"], sample_size=MERGED_K, name="part") for p in parts]
    return synopsis.merge_sketches(spark, *built, key="event_id", sample_size=MERGED_K)


@register("merged_profile", _profile_oracle())
def merged_profile(spark, d):
    # D19 refreshed by a part: moments merged pairwise
    ev = table(spark, d, "events")
    parts = [synopsis.build_profile(ev.where(p), ["event_type"], "part") for p in ("event_id % 3 = 0", "event_id % 3 > 0")]
    return rounded(spark.read.parquet(synopsis.merge_profiles(spark, *parts)), mean=4, std=4, sum=4)


@register(
    "merged_samples",
    f"WITH r AS (SELECT event_id, event_type, row_number() OVER (ORDER BY {sql_priority('event_id', 42)}, {sql_key('event_id')}) AS a, count(*) OVER () AS n, "
    f"row_number() OVER (PARTITION BY event_type ORDER BY {sql_priority('event_id', 42)}, {sql_key('event_id')}) AS b, count(*) OVER (PARTITION BY event_type) AS m FROM events) "
    f"SELECT 'sample' AS synopsis, event_id, n::BIGINT AS pop_n, least(n, {MERGED_K})::BIGINT AS take_n FROM r WHERE a <= {MERGED_K} "
    f"UNION ALL SELECT event_type, event_id, m::BIGINT, least(m, {MERGED_K})::BIGINT FROM r WHERE b <= {MERGED_K}",
)
def merged_samples(spark, d):
    # The samples of the parts merge into the sample of the whole, sizes and weights with them
    paths = _merged(spark, d)
    out = spark.read.parquet(paths["sample"]).select(F.lit("sample").alias("synopsis"), "event_id", "pop_n", "take_n")
    return out.unionByName(spark.read.parquet(paths["stratified"]).select(F.col("strata_value").alias("synopsis"), "event_id", "pop_n", "take_n"))


@register(
    "merged_sketches",
    f"WITH cms AS ({cms_sql('SELECT event_type FROM events', 'event_type')}) "
    "SELECT 'cms' AS synopsis, depth_row::BIGINT AS a, bucket::BIGINT AS b, cnt AS c FROM cms UNION ALL SELECT 'hll', 1, 1, (SELECT count(DISTINCT user_id) FROM events)::BIGINT",
)
def merged_sketches(spark, d):
    # Cells add up; the union of the parts' HLL sketches is near the exact count (shown where it is)
    paths = _merged(spark, d)
    cells = spark.read.parquet(paths["cms"]).select(F.lit("cms").alias("synopsis"), F.col("depth_row").cast("long").alias("a"), F.col("bucket").cast("long").alias("b"), F.col("cnt").alias("c"))
    est = synopsis.distinct_from_sketch(spark, paths["hll"], "user_id").first()[0]
    exact = table(spark, d, "events").agg(F.count_distinct("user_id").cast("long").alias("c"))
    hll = exact.select(F.lit("hll").alias("synopsis"), (F.abs(F.lit(est) - F.col("c")) <= TOL * F.col("c")).cast("long").alias("a"), F.lit(1).cast("long").alias("b"), "c")
    return cells.unionByName(hll)
