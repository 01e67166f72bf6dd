"""One-call facade (I2): ``sample_data(df, size, method, ...)`` -> (sample, bounds).

Samplers and estimators are plain DataFrame -> DataFrame functions, so a user can also compose
them with ``df.transform``; this facade only dispatches by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import bounds, samplers
from .plans.allocation import strata_sizes

SAMPLING_METHODS = ("simple", "stratified", "cluster", "systematic", "reservoir", "weighted")


def sample_data(
    df: DataFrame,
    size: int,
    method: str = "simple",
    value: str = "value",
    key: str | Sequence[str] = "id",
    confidence: float = 0.95,
    error_method: str = "normal",
    seed: int = 42,
    strata: str | None = None,
    cluster: str | None = None,
    order_by: str | None = None,
    weight: str | None = None,
    allocation: str = "proportional",
    n_bootstrap: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """Draw a sample with ``method`` and estimate the mean of ``value`` with error bounds.

    ``error_method`` is honoured for every sampler: ``normal`` takes the sampler's own design-based
    interval (simple, stratified, cluster, systematic, reservoir, weighted), ``student_t`` and
    ``bootstrap`` those of the sample (of the strata, for a stratified sample), ``non_parametric`` the
    order statistics. A weighted sample's rows aren't alike, so that it only takes ``normal``.
    """
    bounds.validate_config(confidence, error_method, n_bootstrap)
    if method not in SAMPLING_METHODS:
        raise ValueError(f"{method!r} is not one of {SAMPLING_METHODS}")
    if method == "weighted" and error_method != "normal":
        raise ValueError("a weighted sample is estimated by inclusion probabilities: use error_method='normal'")
    if method == "simple":
        smp, _, N = samplers.sized_random(df, lambda n: min(n, size), key, seed)
    elif method == "stratified":
        smp = samplers.stratified(df, size, strata, key, seed, allocation, value if allocation == "neyman" else None)
        sizes = strata_sizes(df, strata)
        if error_method == "bootstrap":
            return smp, bounds.stratified_bootstrap_bounds(smp, value, strata, sizes, key, n_bootstrap, confidence, seed)
        if error_method != "non_parametric":
            return smp, bounds.stratified_bounds(smp, value, strata, sizes, error_method, confidence)
    elif method == "cluster":
        smp = samplers.cluster(df, size, cluster, seed)
    elif method == "systematic":
        smp = samplers.systematic(df, size, order_by, seed, key=key)
    elif method == "reservoir":
        smp = samplers.reservoir(df, size, key, seed)
    else:
        smp = samplers.weighted(df, size, key, weight, seed)
        valid = df.where(F.col(weight).cast("double") > 0).where(~F.isnan(F.col(weight).cast("double"))).count()
        return smp, bounds.weighted_bounds(smp, value, weight, confidence, population=valid)
    N = N if method == "simple" else df.count()
    if error_method == "bootstrap":
        return smp, bounds.bootstrap_bounds(smp, value, key, n_bootstrap, confidence, seed, population=N)
    if error_method == "non_parametric":
        return smp, bounds.order_statistic_bounds(smp, value, confidence, population=N)
    if error_method == "normal" and method in ("cluster", "systematic", "reservoir"):
        return smp, bounds.design_bounds(smp, value, method, confidence, population=N)
    return smp, bounds.mean_bounds(smp, value, error_method, confidence, population=N)


def describe(bounds_row: DataFrame) -> DataFrame:
    """Human-readable one-liner per bounds row (estimate +- margin)."""
    return bounds_row.select(
        "*", F.format_string("%.4f +- %.4f (%s, %.0f%%)", "estimate", "margin_of_error", "method", F.col("confidence_level") * 100).alias("summary")
    )
