"""Error bounds for sample means.

Output: one row per estimate (per group with ``by``) with the columns of ``BOUNDS_COLUMNS``:
estimate, lower_bound, upper_bound, confidence_level, sample_size, population_size, method,
distribution_type, n_iterations, margin_of_error, relative_error.

Values are coerced to double and NULL/NaN/+-Inf are dropped first (B5). With no finite value
the bounds are 0, 0, 0 with n = 0; with one value they collapse onto it (F12). Every estimator
is one aggregate over the sample (partial aggregation per partition, so it scales with the
number of groups, not with the sample); the bootstrap draws its replicates where the rows are.
Values keep full precision; callers round.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import as_list, key_string
from ..functions.stats import t_quantile, z_value
from .exact import finite_values
from .joins import join_keys
from .ranking import global_rank

BOUNDS_COLUMNS = [
    "estimate",
    "lower_bound",
    "upper_bound",
    "confidence_level",
    "sample_size",
    "population_size",
    "method",
    "distribution_type",
    "n_iterations",
    "margin_of_error",
    "relative_error",
]

METHODS = ("normal", "student_t", "bootstrap", "non_parametric")
DISTRIBUTION = {"normal": "NORMAL", "student_t": "STUDENT_T", "bootstrap": "BOOTSTRAP", "non_parametric": "NON_PARAMETRIC"}
# Fixed values that must equal the reference's behaviour:
# design effect applied to a cluster sample's variance when N is known; systematic variance factor
CLUSTER_DESIGN_EFFECT = 1.5
SYSTEMATIC_VARIANCE_FACTOR = 0.8


def validate_config(confidence: float, method: str = "normal", n_bootstrap: int = 1000) -> None:
    """F14 (config part): confidence in (0, 1), a known method, at least one bootstrap replicate."""
    if not 0 < confidence < 1:
        raise ValueError("Confidence level must be between 0 and 1")
    if method not in METHODS:
        raise ValueError(f"{method!r} is not one of {METHODS}")
    if n_bootstrap < 1:
        raise ValueError("a bootstrap needs at least one replicate")


def finite_or_null(value: str) -> Column:
    """try_cast to double; NaN and +-Inf become NULL (so groups without finite values keep n = 0)."""
    x = F.expr(f"try_cast(`{value}` as double)")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def _moments(sample: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    clean = sample.select(*by, finite_or_null(value).alias("_x"))
    aggs = [F.count("_x").alias("_n"), F.avg("_x").alias("_mean"), F.stddev_samp("_x").alias("_sd")]
    return clean.groupBy(*by).agg(*aggs) if by else clean.agg(*aggs)


def _pop(population) -> Column:
    if population is None:
        return F.lit(None).cast("long")
    if isinstance(population, Column):
        return population.cast("long")
    if isinstance(population, str):
        return F.col(population).cast("long")
    return F.lit(int(population)).cast("long")


def _fpc(n: Column, N: Column) -> Column:
    """sqrt((N - n) / (N - 1)); NULL population -> 1; n = N -> 0."""
    return F.when(N.isNull(), F.lit(1.0)).otherwise(F.sqrt(F.greatest(N - n, F.lit(0)) / F.when(N - 1 > 0, N - 1)))


def finish(df: DataFrame, by: Sequence[str], est: Column, lo: Column, hi: Column, n: Column, N: Column, confidence: float,
           method: str, dist: str | None, iterations: int | None = None) -> DataFrame:
    """Apply the degenerate rules and derived columns; select the bounds columns."""
    est_f = F.when(n == 0, F.lit(0.0)).otherwise(est)
    lo_f = F.when(n == 0, F.lit(0.0)).when(n == 1, est).otherwise(lo)
    hi_f = F.when(n == 0, F.lit(0.0)).when(n == 1, est).otherwise(hi)
    out = df.select(
        *by,
        est_f.alias("estimate"),
        lo_f.alias("lower_bound"),
        hi_f.alias("upper_bound"),
        F.lit(float(confidence)).alias("confidence_level"),
        n.cast("long").alias("sample_size"),
        N.alias("population_size"),
        F.lit(method).alias("method"),
        F.lit(dist).cast("string").alias("distribution_type"),
        F.lit(iterations).cast("long").alias("n_iterations"),
        ((hi_f - lo_f) / 2).alias("margin_of_error"),
        F.when(est_f == 0, F.lit(float("inf"))).otherwise((hi_f - lo_f) / 2 / F.abs(est_f)).alias("relative_error"),
    )
    return out


def mean_bounds(
    sample: DataFrame,
    value: str,
    method: str = "normal",
    confidence: float = 0.95,
    population=None,
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Normal or Student-t interval for the mean, fpc on the margin when N is given.

    ``population``: an int N, or (with ``by``) the name of a column holding N per group.
    """
    validate_config(confidence, method)
    if method not in ("normal", "student_t"):
        raise ValueError("mean_bounds handles normal and student_t; see bootstrap_bounds / order_statistic_bounds")
    by = as_list(by)
    m = _moments(sample, value, by + ([population] if isinstance(population, str) else []))
    n, mean, sd = F.col("_n"), F.col("_mean"), F.col("_sd")
    N = _pop(population)
    crit = F.lit(z_value(confidence)) if method == "normal" else t_quantile(confidence, n - 1)
    margin = crit * sd / F.sqrt(n) * _fpc(n, N)
    return finish(m, by, mean, mean - margin, mean + margin, n, N, confidence, method, DISTRIBUTION[method])


def design_bounds(sample: DataFrame, value: str, design: str, confidence: float = 0.95, population=None) -> DataFrame:
    """Bounds for cluster, systematic and reservoir samples.

    cluster     z sqrt(var deff / n), deff = 1.5 when N is given, no fpc
    systematic  z sqrt(var 0.8 f / n), f = sqrt((N-n)/(N-1)) when N is given (as the reference)
    reservoir   t(n-1) s / sqrt(n) x fpc
    """
    validate_config(confidence)
    m = _moments(sample, value, [])
    n, mean, sd = F.col("_n"), F.col("_mean"), F.col("_sd")
    N = _pop(population)
    var = sd * sd
    z = F.lit(z_value(confidence))
    if design == "cluster":
        deff = F.lit(CLUSTER_DESIGN_EFFECT if population is not None else 1.0)
        margin, dist = z * F.sqrt(var * deff / n), "NORMAL"
    elif design == "systematic":
        margin, dist = z * F.sqrt(var * F.lit(SYSTEMATIC_VARIANCE_FACTOR) * _fpc(n, N) / n), "NORMAL"
    elif design == "reservoir":
        margin, dist = t_quantile(confidence, n - 1) * sd / F.sqrt(n) * _fpc(n, N), "STUDENT_T"
    else:
        raise ValueError(f"unknown design: {design}")
    return finish(m, [], mean, mean - margin, mean + margin, n, N, confidence, design, dist)


def stratified_bounds(
    sample: DataFrame,
    value: str,
    strata: str | Sequence[str],
    strata_sizes: DataFrame,
    method: str = "normal",
    confidence: float = 0.95,
) -> DataFrame:
    """stratified mean sum W_h xbar_h, variance sum W_h^2 s_h^2 / n_h times (N-n)/(N-1).

    W_h = N_h / N from ``strata_sizes`` (strata, pop_n). Strata with one sampled value have no
    variance: counted as 0 and reported in ``strata_without_variance``. Student t uses
    df = min(n_h) - 1.
    """
    validate_config(confidence, method)
    if method not in ("normal", "student_t"):
        raise ValueError("stratified_bounds handles normal and student_t; see bootstrap_bounds(strata=...) and order_statistic_bounds")
    strata = as_list(strata)
    per = _moments(sample, value, strata)
    n_total = strata_sizes.agg(F.sum("pop_n")).first()[0] or 0
    sizes = strata_sizes.select(*strata, F.col("pop_n").cast("double").alias("_Nh")).withColumn(
        "_Ntot", F.lit(float(n_total))
    )
    j = join_keys(per, sizes, strata)
    W = F.col("_Nh") / F.col("_Ntot")
    agg = j.agg(
        F.sum(W * F.col("_mean")).alias("_est"),
        F.sum(W * W * F.coalesce(F.col("_sd") * F.col("_sd"), F.lit(0.0)) / F.col("_n")).alias("_var"),
        F.sum("_n").alias("_n_all"),
        F.first("_Ntot").cast("long").alias("_N"),
        F.min("_n").alias("_min_nh"),
        F.sum(F.when(F.col("_n") < 2, 1).otherwise(0)).cast("long").alias("strata_without_variance"),
    )
    n, N = F.col("_n_all"), F.col("_N")
    var = F.col("_var") * F.greatest(N - n, F.lit(0)) / F.when(N - 1 > 0, N - 1)
    crit = F.lit(z_value(confidence)) if method == "normal" else t_quantile(confidence, F.col("_min_nh") - 1)
    margin = crit * F.sqrt(var)
    est = F.col("_est")
    res = finish(agg, ["strata_without_variance"], est, est - margin, est + margin, n, N, confidence,
                 f"stratified_{method}", DISTRIBUTION[method])
    return res.select(*BOUNDS_COLUMNS, "strata_without_variance")


def poisson_limits() -> list[str]:
    """Cumulative Poisson(1) probabilities as 32-bit hex text: a uniform below the k-th and not below the one before means k."""
    limits, p, total = [], math.exp(-1.0), 0.0
    for k in range(1, 16):
        total += p
        p /= k
        if total * 2**32 >= 2**32 - 1:
            break
        limits.append(format(int(total * 2**32), "08x"))
    return limits


def _multiplicity(u: Column) -> Column:
    """How often a row is drawn, Poisson(1) by the hex text of its uniform."""
    limits = poisson_limits()
    m = F.when(u < limits[0], 0)
    for k, limit in enumerate(limits[1:], 1):
        m = m.when(u < limit, k)
    return m.otherwise(len(limits))


class ArrayStatistic:
    """A statistic given as a function of an array: ``ArrayStatistic(lambda x: numpy.median(x))``.

    A replicate's values (those of one group) are one array in a Python worker, so that the sample, not the
    table, has to fit there.
    """

    def __init__(self, fn: Callable[[np.ndarray], float]) -> None:
        self.fn = fn


#: Replicates drawn from one digest (8 hex digits each).
PER_DIGEST = 4


def _digests(rows: DataFrame, key: Sequence[str], seed: int, n_bootstrap: int) -> DataFrame:
    """Each row once per digest (_g, _d), which holds its uniforms for ``PER_DIGEST`` replicates."""
    turns = F.explode(F.sequence(F.lit(0), F.lit((n_bootstrap - 1) // PER_DIGEST))).alias("_g")
    rows = rows.select("*", turns)
    return rows.withColumn("_d", F.md5(F.concat(F.lit(f"{seed}:"), F.col("_g").cast("string"), F.lit(":"), key_string(key))))


def _drawn(i: int) -> Column:
    return _multiplicity(F.substring("_d", 8 * i + 1, 8))


def _mean_replicates(rows: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, n_bootstrap: int) -> DataFrame:
    """(by, _b, _m, _s): rows drawn and the sum of their values in each replicate, summed within the scan's tasks;
    _b = -1 is the sample itself."""
    sums = [e for i in range(PER_DIGEST) for e in (F.sum(_drawn(i)).alias(f"_m{i}"), F.sum(_drawn(i) * F.col("_x")).alias(f"_s{i}"))]
    wide = _digests(rows, key, seed, n_bootstrap).groupBy(*by, "_g").agg(*sums)
    each = F.explode(F.array(*[F.struct((F.col("_g") * PER_DIGEST + i).alias("_b"), F.col(f"_m{i}").alias("_m"), F.col(f"_s{i}").alias("_s")) for i in range(PER_DIGEST)]))
    reps = wide.select(*by, each.alias("_r")).select(*by, "_r.*").where(F.col("_b") < n_bootstrap)
    own = rows.groupBy(*by).agg(F.count("_x").alias("_m"), F.sum("_x").alias("_s")).select(*by, F.lit(-1).alias("_b"), "_m", "_s")
    return reps.unionByName(own)


def _replicates(rows: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, n_bootstrap: int, estimator) -> DataFrame:
    """(by, _b, _stat, _n): the statistic of each replicate; _b = -1 is the sample itself, of _n rows."""
    if estimator is F.avg:
        return _mean_replicates(rows, by, key, seed, n_bootstrap).select(*by, "_b", (F.col("_s") / F.when(F.col("_m") > 0, F.col("_m"))).alias("_stat"), F.col("_m").alias("_n"))
    slices = F.explode(F.array(*[F.struct((F.col("_g") * PER_DIGEST + i).alias("_b"), _drawn(i).alias("_m")) for i in range(PER_DIGEST)]))
    drawn = _digests(rows, key, seed, n_bootstrap).select(*by, "_x", slices.alias("_r")).select(*by, "_x", "_r.*").where((F.col("_b") < n_bootstrap) & (F.col("_m") > 0))
    drawn = drawn.unionByName(rows.select(*by, "_x", F.lit(-1).alias("_b"), F.lit(1).alias("_m")))
    if isinstance(estimator, ArrayStatistic):
        fn, keys = estimator.fn, [*by, "_b"]

        def statistic(group: pd.DataFrame) -> pd.DataFrame:
            x = np.repeat(group["_x"].to_numpy(), group["_m"].to_numpy())
            return group[keys].head(1).assign(_stat=float(fn(x)), _n=len(x))

        schema = T.StructType([*[drawn.schema[c] for c in keys], T.StructField("_stat", T.DoubleType()), T.StructField("_n", T.LongType())])
        return drawn.groupBy(*keys).applyInPandas(statistic, schema)
    repeated = drawn.select(*by, "_b", "_x", F.explode(F.array_repeat(F.lit(0), F.col("_m"))))
    return repeated.groupBy(*by, "_b").agg(estimator(F.col("_x")).cast("double").alias("_stat"), F.count(F.lit(1)).alias("_n"))


def _interval(reps: DataFrame, by: Sequence[str], confidence: float, *more: Column) -> DataFrame:
    """Keys, estimate _m, _n, percentiles _lo and _hi of the replicates."""
    alpha = (1 - confidence) / 2
    own = F.col("_b") == -1
    ends = F.percentile(F.when(~own, F.col("_stat")), F.array(F.lit(alpha * 1.0), F.lit(1 - alpha))).alias("_q")
    q = reps.groupBy(*by).agg(ends, F.max(F.when(own, F.col("_stat"))).alias("_m"), F.coalesce(F.max(F.when(own, F.col("_n"))), F.lit(0)).cast("long").alias("_n"), *more)
    return q.withColumns({"_lo": F.coalesce(F.col("_q")[0], F.col("_m")), "_hi": F.coalesce(F.col("_q")[1], F.col("_m"))})


def bootstrap_bounds(
    sample: DataFrame,
    value: str,
    key: str | Sequence[str],
    n_bootstrap: int = 1000,
    confidence: float = 0.95,
    seed: int = 42,
    estimator: Callable[[Column], Column] | ArrayStatistic = F.avg,
    population=None,
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Percentile bootstrap, per group with ``by``.

    Replicate b draws a row as often as a Poisson(1) variable that follows from hash(seed, b, key) says, so
    that replicates are drawn where the rows are: the sample is read once, nothing is ranked or joined, and
    the mean's replicates are summed within the tasks. ``key`` tells rows apart (rows of one key are drawn
    together). The statistic is any aggregate Column function (mean by default, ``F.median`` for F5) or the user's own
    function of an array (:class:`ArrayStatistic`); the estimate is that statistic of the sample. A replicate that draws
    no row of a group has no statistic and is left out. No fpc (as the reference).
    """
    validate_config(confidence, "bootstrap", n_bootstrap)
    by, key = as_list(by), as_list(key)
    clean = finite_values(sample.select(*dict.fromkeys(by + key + [value])), value, "_x")
    reps = _replicates(clean.select(*dict.fromkeys(by + key), "_x"), by, key, seed, n_bootstrap, estimator)
    return finish(_interval(reps, by, confidence), by, F.col("_m"), F.col("_lo"), F.col("_hi"), F.col("_n"), _pop(population), confidence, "bootstrap", "BOOTSTRAP", n_bootstrap)


def stratified_bootstrap_bounds(
    sample: DataFrame,
    value: str,
    strata: str | Sequence[str],
    strata_sizes: DataFrame,
    key: str | Sequence[str],
    n_bootstrap: int = 1000,
    confidence: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """F4 for a stratified sample: each replicate draws every stratum's rows as :func:`bootstrap_bounds` does; its
    statistic is the stratified mean sum W_h xbar_h over the strata that it draws from, W_h = N_h over their sizes. NULL is a stratum."""
    validate_config(confidence, "bootstrap", n_bootstrap)
    strata, key = as_list(strata), as_list(key)
    clean = finite_values(sample.select(*dict.fromkeys(strata + key + [value])), value, "_x")
    sums = _mean_replicates(clean.select(*dict.fromkeys(strata + key), "_x"), strata, key, seed, n_bootstrap).where("_m > 0")
    weighed = join_keys(sums, strata_sizes.select(*strata, F.col("pop_n").cast("double").alias("_w")), strata)
    stat = (F.sum(F.col("_w") * F.col("_s") / F.col("_m")) / F.sum("_w")).alias("_stat")
    reps = weighed.groupBy("_b").agg(stat, F.sum("_m").alias("_n"), F.sum("_w").cast("long").alias("_all"))
    q = _interval(reps, [], confidence, F.max(F.when(F.col("_b") == -1, F.col("_all"))).alias("_pop"))
    return finish(q, [], F.col("_m"), F.col("_lo"), F.col("_hi"), F.col("_n"), F.col("_pop"), confidence, "stratified_bootstrap", "BOOTSTRAP", n_bootstrap)


def order_statistic_bounds(sample: DataFrame, value: str, confidence: float = 0.95, population=None) -> DataFrame:
    """F8: order statistics at floor(n a) and min(ceil(n (1 - a)), n - 1), a = (1 - conf) / 2 (0-based).

    It bounds the values, not the mean; the estimate is the mean. Rows whose mean falls outside
    are flagged by ``bounds_validate`` rather than raised.
    """
    validate_config(confidence, "non_parametric")
    clean = finite_values(sample.select(value), value, "_x").select("_x")
    ranked = global_rank(clean, [F.col("_x")], "_i")
    alpha = (1 - confidence) / 2
    whole = ranked.agg(F.count(F.lit(1)).alias("n"), F.avg("_x").alias("m")).first()
    n = F.lit(whole["n"]).cast("long")
    lo_i, hi_i = F.floor(n * F.lit(alpha)), F.least(F.ceil(n * F.lit(1 - alpha)), n - 1)
    agg = ranked.agg(F.max(F.when(F.col("_i") == lo_i, F.col("_x"))).alias("_lo"), F.max(F.when(F.col("_i") == hi_i, F.col("_x"))).alias("_hi"))
    agg = agg.select("*", n.alias("_n"), F.lit(whole["m"]).cast("double").alias("_m"))
    return finish(agg, [], F.col("_m"), F.col("_lo"), F.col("_hi"), F.col("_n"), _pop(population), confidence, "non_parametric", "NON_PARAMETRIC")


def weighted_bounds(sample: DataFrame, value: str, weight: str, confidence: float = 0.95, population: int | None = None) -> DataFrame:
    """Bounds for the mean from a weighted sample (``samplers.weighted``), by inverse inclusion probability.

    Given the largest race drawn as the limit t, every other drawn row was included with probability
    1 - exp(-w t); the row of the limit itself isn't used (bottom-k estimation). The estimate is the
    ratio sum(x / p) / sum(1 / p), its variance the linearised one. A sample that holds all
    ``population`` rows has probability 1 throughout.
    """
    validate_config(confidence)
    t = sample.agg(F.max(-F.col("es_key")).alias("t"), F.count(F.lit(1)).alias("n")).first()
    census = t["n"] == 0 or (population is not None and t["n"] >= population)
    p = F.lit(1.0) if census else 1 - F.exp(-F.col(weight).cast("double") * F.lit(t["t"]))
    used = sample if census else sample.where(-F.col("es_key") < F.lit(t["t"]))
    rows = used.select(finite_or_null(value).alias("_x"), p.alias("_p")).where("_x IS NOT NULL")
    g = rows.agg(F.sum(F.col("_x") / F.col("_p")).alias("s"), F.sum(1 / F.col("_p")).alias("h")).first()
    mean, size = (g["s"] / g["h"], g["h"]) if g["h"] else (0.0, 1.0)
    spread = (1 - F.col("_p")) / (F.col("_p") * F.col("_p")) * (F.col("_x") - F.lit(mean)) * (F.col("_x") - F.lit(mean))
    v = rows.agg(F.count(F.lit(1)).alias("_n"), F.sqrt(F.coalesce(F.sum(spread), F.lit(0.0))).alias("_sd"))
    margin = F.lit(z_value(confidence)) * F.col("_sd") / F.lit(size)
    return finish(v, [], F.lit(mean), F.lit(mean) - margin, F.lit(mean) + margin, F.col("_n"), _pop(population), confidence, "weighted", "NORMAL")


def validate_rows(bounds: DataFrame) -> DataFrame:
    """F14 (row part): valid = 0 < conf < 1, n >= 0, N >= n (when known), lower <= est <= upper."""
    c = F.col
    valid = (
        (c("confidence_level") > 0) & (c("confidence_level") < 1) & (c("sample_size") >= 0)
        & (c("population_size").isNull() | (c("population_size") >= c("sample_size")))
        & (c("lower_bound") <= c("estimate")) & (c("estimate") <= c("upper_bound"))
    )
    return bounds.withColumn("valid", valid)
