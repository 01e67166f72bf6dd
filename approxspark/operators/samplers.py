"""Deterministic samplers.

Every sampler keeps the rows with the smallest priority ``md5(seed:key)`` (see functions.keys):
a bottom-k sample is a uniform sample without replacement, mergeable across batches and
independent of partitioning, so a replayed task or a lost executor yields the same rows. Rows with
equal keys have equal priorities; they are told apart by their place in the scan, or, so that a sample
of repeated keys is the same under any partitioning, by the values of the columns named as ``tie``.

Two passes, whatever the size. The first counts rows per stratum and priority bucket (the
priority's leading zeros and its next two hex digits: a few hundred to two thousand buckets per
stratum, pre-aggregated within tasks). From the counts follow the strata's sizes and, for a quota of
n rows, the bucket in which the n-th smallest priority lies. The second pass keeps every row below
that bucket and ranks only within it (at most a sixteenth of the quota). No stratum, however
hot, and no sample, however large, is sorted in one task, and no row is joined back by its key, so
repeated and NULL keys are safe. Columns that neither the sampler nor the caller names aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import as_list, key_string, priority, uniform
from ..plans.allocation import allocate
from ..plans.sizing import required_sample_size
from ..session import store
from .joins import join_keys
from .ranking import global_rank

PRIO = "_prio"
BUCKET = "_bucket"
#: Hex digits of a bucket after the priority's leading zeros.
DIGITS = 2


def bucket_of(prio: Column) -> Column:
    """A prefix of the priority: its leading zeros and the next digits. Buckets sort as their priorities do."""
    return F.substring(prio, F.lit(1), 32 - F.length(F.ltrim(prio, F.lit("0"))) + DIGITS)


def _tie(tie: str | Sequence[str] | None) -> Column:
    """What tells rows of one key apart: the named columns' values, or the place in the scan."""
    return F.xxhash64(*as_list(tie)) if tie else F.monotonically_increasing_id()


def histogram(df: DataFrame, by: str | Sequence[str], key: str | Sequence[str], seed: int, value_col: str | None = None) -> DataFrame:
    """Rows per stratum and priority bucket, written once: (by..., _bucket, _n), with ``value_col`` also
    the bucket's count, mean and squared deviations of its values."""
    x = F.col(value_col).cast("double") if value_col else None
    aggs = [F.count(F.lit(1)).alias("_n")]
    if value_col:
        aggs += [F.count(x).alias("_nv"), F.avg(x).alias("_mean"), (F.var_pop(x) * F.count(x)).alias("_dev")]
    return store(df.groupBy(*as_list(by), bucket_of(priority(key, seed)).alias(BUCKET)).agg(*aggs), "buckets")[0]


def sizes_of(hist: DataFrame, by: str | Sequence[str], deviations: bool = False) -> DataFrame:
    """(by..., pop_n) of a histogram; with ``deviations`` also pop_sd, the sample standard deviation."""
    by = as_list(by)
    sizes = hist.groupBy(*by).agg(F.sum("_n").alias("pop_n"))
    if not deviations:
        return sizes
    mean = hist.groupBy(*by).agg((F.sum(F.col("_mean") * F.col("_nv")) / F.sum("_nv")).alias("_all"))
    apart = F.col("_mean") - F.col("_all")
    spread = join_keys(hist, mean, by).groupBy(*by).agg(F.sum("_nv").alias("_v"), F.sum(F.col("_dev") + F.col("_nv") * apart * apart).alias("_d"))
    sd = F.when(F.col("_v") > 1, F.sqrt(F.col("_d") / (F.col("_v") - 1)))
    return join_keys(sizes, spread.withColumn("pop_sd", sd).drop("_v", "_d"), by)


def _cut(counts: list[tuple[str, int]], k: int) -> tuple[str, int]:
    """The bucket that holds the k-th smallest of sorted (bucket, rows), and how many of its rows are wanted."""
    seen = 0
    for bucket, n in counts:
        if seen + n >= k:
            return bucket, k - seen
        seen += n
    return "g", 0  # above every hex digit: all rows


def _below(rows: DataFrame, cut: Column, rest: Column, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows below bucket ``cut`` and the first ``rest`` rows of it (``_prio`` and ``_bucket`` present)."""
    rows = rows.withColumn("_cut", cut).withColumn("_rest", rest).where(F.col(BUCKET) <= F.col("_cut"))
    place = F.row_number().over(Window.partitionBy(*by, BUCKET).orderBy(*order))
    return rows.withColumn("_place", place).where((F.col(BUCKET) < F.col("_cut")) | (F.col("_place") <= F.col("_rest"))).drop("_cut", "_rest", "_place")


def simple_random(df: DataFrame, k: int, key: str | Sequence[str], seed: int = 42, tie: str | Sequence[str] | None = None) -> DataFrame:
    """K rows without replacement (all rows when k >= N). Adds ``sampling_weight`` = N / n."""
    return sized_random(df, lambda _n: k, key, seed, tie)[0]


def sized_random(df: DataFrame, size, key: str | Sequence[str], seed: int = 42, tie: str | Sequence[str] | None = None) -> tuple[DataFrame, int, int]:
    """E1 when the size follows from the number of rows: (sample, n, N) for n = size(N), at most N.

    The histogram (at most 32 x 255 buckets) comes to the driver, and with it N: no pass counts rows alone.
    """
    prio = priority(key, seed)
    counts = sorted((r[0], r[1]) for r in df.groupBy(bucket_of(prio).alias(BUCKET)).agg(F.count(F.lit(1)).alias("_n")).collect())
    total = sum(n for _, n in counts)
    k = size(total)
    if k < 0:
        raise ValueError("sample size must be non-negative")
    if k >= total:
        return df.withColumn("sampling_weight", F.lit(1.0)), total, total
    if k == 0:
        return df.withColumn("sampling_weight", F.lit(0.0)).limit(0), 0, total
    cut, rest = _cut(counts, k)
    rows = df.withColumn("_tie", _tie(tie)).withColumn(PRIO, prio).withColumn(BUCKET, bucket_of(F.col(PRIO)))
    out = _below(rows, F.lit(cut), F.lit(rest), [F.col(PRIO), key_string(key), F.col("_tie")])
    return out.drop(PRIO, BUCKET, "_tie").withColumn("sampling_weight", F.lit(total / k)), k, total


def from_plan(df: DataFrame, plan: DataFrame, by: str | Sequence[str], key: str | Sequence[str], seed: int = 42,
              hist: DataFrame | None = None, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Draw ``take_n`` bottom-priority rows per stratum for a plan (by, pop_n, take_n); NULL is a stratum.

    Output: the input columns plus ``pop_n``, ``take_n`` and ``sampling_weight`` = pop_n / take_n.
    ``hist`` is the :func:`histogram` of the same rows, key and seed, when the plan was made from it;
    otherwise it is counted here.
    """
    by = as_list(by)
    hist = histogram(df, by, key, seed) if hist is None else hist
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, 0))
    plan = plan.select(*by, "pop_n", "take_n").where(F.col("take_n") > 0)
    cuts = join_keys(hist.select(*by, BUCKET, "_n", upto.alias("_to")), plan, by).where((F.col("_to") >= F.col("take_n")) & (F.col("_to") - F.col("_n") < F.col("take_n")))
    cuts = cuts.select(*by, "pop_n", "take_n", F.col(BUCKET).alias("_cut"), (F.col("take_n") - F.col("_to") + F.col("_n")).alias("_rest"))
    rows = join_keys(df.withColumn("_tie", _tie(tie)), cuts, by).withColumn(PRIO, priority(key, seed)).withColumn(BUCKET, bucket_of(F.col(PRIO)))
    out = _below(rows, F.col("_cut"), F.col("_rest"), [F.col(PRIO), key_string(key), F.col("_tie")], by)
    return out.drop(PRIO, BUCKET, "_tie").withColumn("sampling_weight", F.col("pop_n") / F.col("take_n"))


def stratified(
    df: DataFrame,
    k: int,
    by: str | Sequence[str],
    key: str | Sequence[str],
    seed: int = 42,
    rule: str = "proportional",
    value_col: str | None = None,
    tie: str | Sequence[str] | None = None,
) -> DataFrame:
    """Stratified sample of total size k (or every row, if fewer) under an allocation rule."""
    if rule == "neyman" and value_col is None:
        raise ValueError("Neyman allocation needs value_col (the stratum standard deviations)")
    hist = histogram(df, by, key, seed, value_col if rule == "neyman" else None)
    plan = allocate(sizes_of(hist, by, deviations=rule == "neyman"), k, by, rule, stored=True)
    return from_plan(df, plan, by, key, seed, hist, tie)


def weighted(df: DataFrame, k: int, key: str | Sequence[str], weight: str, seed: int = 42, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Weighted sample without replacement (Efraimidis-Spirakis).

    Row key r = ln(u) / w, the k largest win; equivalently the k smallest exponential races
    E = -ln(u) / w. Rows with w <= 0 or NULL/NaN weight are never drawn. Races are counted in buckets of
    an eighth of a power of two (some hundreds, collected); the second pass keeps those below the bucket
    of the k-th and ranks within it. Adds ``es_key``.
    """
    u = uniform(priority(key, seed))
    wcol = F.col(weight).cast("double")
    valid = df.where(wcol.isNotNull() & ~F.isnan(wcol) & (wcol > 0)).withColumn("es_key", F.log(u) / wcol)
    return _first_races(valid, k, key, tie)


def merge_weighted(k: int, key: str | Sequence[str], *samples: DataFrame, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Weighted samples (of ``k`` rows each, with their es_key) of disjoint parts to that of their union.

    A row's race doesn't depend on other rows, and the k first of all are among the k first of their parts.
    """
    return _first_races(reduce(DataFrame.unionByName, samples), k, key, tie)


def _first_races(valid: DataFrame, k: int, key: str | Sequence[str], tie: str | Sequence[str] | None) -> DataFrame:
    race = -F.col("es_key")
    step = F.when(race > 0, F.floor(F.log2(race) * 8)).otherwise(F.lit(-100_000)).cast("int")
    counts = sorted((r[0], r[1]) for r in valid.groupBy(step.alias(BUCKET)).agg(F.count(F.lit(1)).alias("n")).collect())
    if sum(n for _, n in counts) <= k:
        return valid
    cut, rest = _cut(counts, k)
    order = [F.col("es_key").desc(), key_string(key), F.col("_tie")]
    return _below(valid.withColumn("_tie", _tie(tie)).withColumn(BUCKET, step), F.lit(cut), F.lit(rest), order).drop("_tie", BUCKET)


def cluster(df: DataFrame, k: int | None, cluster_col: str, seed: int = 42, error_margin: float | None = None, confidence: float = 0.95) -> DataFrame:
    """Choose k clusters by priority, keep all of their rows. Without k, an error margin sizes the
    number of clusters. NULL is a cluster."""
    size = _size(k, error_margin, confidence)
    chosen = sized_random(df.select(cluster_col).distinct(), size, cluster_col, seed)[0].select(cluster_col)
    return join_keys(df, chosen, cluster_col, "left_semi")


def _size(k: int | None, error_margin: float | None, confidence: float):
    """Rows to draw of N: k, or what an error margin asks for."""
    if k is None and error_margin is None:
        raise ValueError("a sample needs a size or an error margin")
    return lambda n: min(n, k if k is not None else required_sample_size(error_margin, n, confidence) if n else 0)


def systematic(df: DataFrame, k: int | None, order_by: str, seed: int = 42, error_margin: float | None = None, confidence: float = 0.95,
               key: str | Sequence[str] | None = None) -> DataFrame:
    """Every (N/k)-th row in ``order_by`` order from a seeded start; exactly min(k, N) rows.

    Target ranks are floor((r + j N) / k), j = 0..k-1, with integer start r = hash(seed) mod N. Ranks come
    from :func:`ranking.global_rank` over the order column and ``key``; whether a rank is a
    target is decided by (exact) arithmetic on the rank itself. The chosen places are joined back by both:
    equal ones count as many targets as they hold and the first of them in the scan are taken, so ties
    are safe and a hot order value is not gathered unless its key repeats as well. Without ``key`` (columns that tell
    rows of one order value apart) a hash of the whole row stands for it, for which every column is read.
    Adds ``_rank`` (0-based).
    """
    size = _size(k, error_margin, confidence)
    tagged = df.withColumn("_tie", _tie(as_list(key) or df.columns))
    ranked = global_rank(tagged.select(order_by, "_tie"), [F.col(order_by).asc_nulls_first(), F.col("_tie")])
    total = ranked.count()
    k = size(total)
    if not k:
        return df.withColumn("_rank", F.lit(None).cast("long")).limit(0)
    whole = lambda x: F.lit(x).cast("decimal(19,0)")  # noqa: E731  products need more than 64 bits
    start, rank = systematic_start(seed, total), F.col("_rank").cast("decimal(19,0)")
    # the first step j that reaches the rank; it hits if it doesn't pass beyond
    ranked = ranked.withColumn("_reach", F.greatest(rank * whole(k) - whole(start), F.lit(0).cast("decimal(38,0)")))
    ranked = ranked.withColumn("_j", F.expr(f"(_reach + {total - 1}BD) div {total}BD"))
    hit = whole(start) + F.col("_j").cast("decimal(19,0)") * whole(total) < (rank + 1) * whole(k)
    number = F.row_number().over(Window.partitionBy(order_by, "_tie").orderBy(F.lit(0)))
    chosen = ranked.where(hit).drop("_reach", "_j").withColumn("_no", number)
    candidates = join_keys(tagged, chosen.select(order_by, "_tie").distinct(), [order_by, "_tie"], "left_semi").withColumn("_no", number)
    return join_keys(candidates, chosen, [order_by, "_tie", "_no"]).drop("_tie", "_no")


def systematic_start(seed: int, total: int) -> int:
    """Seeded integer start in [0, N): first 60 bits of md5('seed:start') mod N."""
    return int(hashlib.md5(f"{seed}:start".encode()).hexdigest()[:15], 16) % total


def reservoir(df: DataFrame, k: int, key: str | Sequence[str], seed: int = 42, strata: str | Sequence[str] | None = None,
              tie: str | Sequence[str] | None = None) -> DataFrame:
    """Bottom-k reservoir (per stratum when ``strata`` is given; NULL is a stratum).

    Same distribution as Algorithm R, but order-independent and mergeable: the reservoir of a
    union is the bottom-k of the two reservoirs.
    """
    if strata is None:
        return simple_random(df, k, key, seed, tie).drop("sampling_weight")
    hist = histogram(df, strata, key, seed)
    plan = sizes_of(hist, strata).withColumn("take_n", F.least(F.col("pop_n"), F.lit(k)).cast("long"))
    return from_plan(df, plan, strata, key, seed, hist, tie).drop("sampling_weight", "pop_n", "take_n")


def multi_seed(df: DataFrame, k: int, key: str | Sequence[str], seeds: Sequence[int], tie: str | Sequence[str] | None = None) -> DataFrame:
    """Bottom-k samples for many seeds in ONE job (replicates for coverage / error studies).

    Output: the input columns plus ``seed``. See :func:`replicates`.
    """
    return replicates(df, key, seeds, [(None, k)], tie).drop("size_label")


def replicates(df: DataFrame, key: str | Sequence[str], seeds: Sequence[int], sizes, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Bottom-k samples for every (size label, seed) pair in two passes over the rows.

    ``sizes`` = [(label, k), ...] or a function of the number of rows that gives it. As for one seed, the first
    pass counts rows per seed and bucket; from the counts follow the bucket that holds a replicate's k-th row and
    how many of its rows are wanted. The second pass pairs each row with the seeds inside the scan stage, keeps
    what lies below the cuts and ranks within the last bucket of each replicate; nothing is counted again or
    retried. A size of more rows than there are takes all. Output: the input columns plus ``seed`` and ``size_label``.
    """
    paired = F.explode(F.array(*[F.lit(int(s)) for s in seeds])).alias("seed")
    prio = F.md5(F.concat(F.col("seed").cast("string"), F.lit(":"), key_string(key)))
    hist, _ = store(df.select(*as_list(key), paired).groupBy("seed", bucket_of(prio).alias(BUCKET)).agg(F.count(F.lit(1)).alias("_n")), "replicates")
    if callable(sizes):
        sizes = sizes(hist.where(F.col("seed") == int(seeds[0])).agg(F.sum("_n")).first()[0] or 0)
    label_type = "double" if all(isinstance(lbl, (int, float)) for lbl, _k in sizes) else "string"
    wanted = F.explode(F.array(*[F.struct(F.lit(lbl).cast(label_type).alias("size_label"), F.lit(int(k)).cast("long").alias("_k")) for lbl, k in sizes])).alias("_o")
    upto = F.sum("_n").over(Window.partitionBy("seed").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, 0))
    of_seed = Window.partitionBy("seed")
    hist = hist.select("seed", BUCKET, "_n", upto.alias("_to"), F.sum("_n").over(of_seed).alias("_rows")).select("*", wanted).select("*", "_o.*")
    k = F.least("_k", "_rows")
    cuts = hist.where((F.col("_to") >= k) & (F.col("_to") - F.col("_n") < k)).groupBy("seed").agg(
        F.max(BUCKET).alias("_last"), F.collect_list(F.struct("size_label", F.col(BUCKET).alias("_cut"), (k - F.col("_to") + F.col("_n")).alias("_rest"))).alias("_cuts"))
    rows = df.withColumn("_tie", _tie(tie)).select("*", paired).withColumn(PRIO, prio).withColumn(BUCKET, bucket_of(F.col(PRIO)))
    rows = rows.join(cuts, "seed").where(F.col(BUCKET) <= F.col("_last"))
    rows = rows.select("*", F.explode("_cuts").alias("_o")).drop("_cuts", "_last").select("*", "_o.*").drop("_o").where(F.col(BUCKET) <= F.col("_cut"))
    place = F.row_number().over(Window.partitionBy("size_label", "seed", BUCKET).orderBy(F.col(PRIO), key_string(key), F.col("_tie")))
    rows = rows.withColumn("_place", place).where((F.col(BUCKET) < F.col("_cut")) | (F.col("_place") <= F.col("_rest")))
    return rows.select(*df.columns, "seed", "size_label")


def sized(df: DataFrame, key: str | Sequence[str], size: int | None = None, error_margin: float | None = None,
          confidence: float = 0.95, seed: int = 42, tie: str | Sequence[str] | None = None) -> DataFrame:
    """Simple random sample of ``size`` rows, or sized from an error margin (at most N).

    Raises when neither is given.
    """
    return sized_random(df, _size(size, error_margin, confidence), key, seed, tie)[0]


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> int:
    """Number of key values that occur more than once (samplers allow them: equal keys tie)."""
    keys = as_list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1).count()
