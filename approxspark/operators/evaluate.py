"""Accuracy evaluation (H1-H6): compare approximate answers with exact ones, as Spark jobs.

Timing and plotting are not built; these functions produce the data behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import as_list
from .joins import join_keys


def error_pct(exact: Column, approx: Column) -> Column:
    """H1: abs(exact - approx) / abs(exact) * 100 (NULL when exact is 0)."""
    return F.abs(exact - approx) / F.when(exact != 0, F.abs(exact)) * 100


def error_by_group(exact: DataFrame, approx: DataFrame, keys: str | Sequence[str], columns: Sequence[str], digits: int = 4) -> DataFrame:
    """H2: per numeric column the mean % error over groups, then the mean over columns.

    Groups are matched by key (full outer join); a group missing on either side counts 100%.
    Output rows: (column, error_pct) for each column plus ('overall', mean of the column means).
    """
    keys = as_list(keys)
    a = approx.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns])
    j = join_keys(exact.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in columns]), a, keys, "full")
    per_col = []
    for c in columns:
        e, ap = F.col(f"_e_{c}").cast("double"), F.col(f"_a_{c}").cast("double")
        err = F.when(e.isNull() | ap.isNull(), F.lit(100.0)).otherwise(error_pct(e, ap))
        per_col.append(F.avg(err).alias(c))  # avg skips NULL (exact value 0)
    means = j.agg(*per_col)
    rows = means.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("error_pct")) for c in columns])).alias("r"))
    rows = rows.select("r.column", "r.error_pct")
    overall = rows.agg(F.avg("error_pct").alias("error_pct")).select(F.lit("overall").alias("column"), "error_pct")
    return rows.unionByName(overall).select("column", F.round("error_pct", digits).alias("error_pct"))


def summarize_errors(errors: DataFrame, by: str = "query", error: str = "error_pct") -> DataFrame:
    """H4: mean / min / max error per query, rounded to 2."""
    return errors.groupBy(by).agg(
        F.round(F.avg(error), 2).alias("mean_error"),
        F.round(F.min(error), 2).alias("min_error"),
        F.round(F.max(error), 2).alias("max_error"),
        F.count(F.lit(1)).cast("long").alias("runs"),
    )


def histogram_density(df: DataFrame, value: str, bins: int, label: str, digits: int = 10) -> DataFrame:
    """H5: equal-width histogram over [min, max] of the data as a density (count / (n width)).

    The last bin is closed on the right. Bin edges come from one aggregate (two scalars).
    """
    st = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n")).first()
    lo, hi, n = st["lo"], st["hi"], st["n"]
    if not n:  # no values, no bins
        lo = hi = 0.0
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(value) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(
        F.lit(label).alias("source"),
        "bin",
        F.round(F.lit(lo) + F.col("bin") * F.lit(width), 6).alias("bin_start"),
        F.round(F.col("cnt") / (F.lit(max(1, n)) * F.lit(width)), digits).alias("density"),
    )


def coverage(replicates: DataFrame, truth: float, by: str = "confidence") -> DataFrame:
    """H3: share of replicates whose interval covers the exact value and whose relative error is
    within (1 - confidence). ``replicates`` rows: confidence, estimate, lower_bound, upper_bound."""
    covered = ((F.col("lower_bound") <= F.lit(truth)) & (F.lit(truth) <= F.col("upper_bound"))).cast("double")
    rel = F.abs(F.col("estimate") - F.lit(truth)) / F.lit(abs(truth))
    return replicates.groupBy(by).agg(
        F.count(F.lit(1)).cast("long").alias("runs"),
        F.round(F.avg(covered), 6).alias("interval_coverage"),
        F.round(F.avg((rel <= F.lit(1.0) - F.col(by)).cast("double")), 6).alias("within_error_share"),
        F.round(F.avg(rel), 6).alias("mean_relative_error"),
    )
