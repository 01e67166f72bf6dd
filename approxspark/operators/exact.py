"""Exact aggregation (C1-C13): one hash aggregate (partial on the map side, final after the
shuffle on the group keys); grouped results are small (one row per group)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.keys import as_list
from .joins import join_keys


def agg_expr(kind: str, col: str | None, alias: str) -> Column:
    if kind == "count":
        e = F.count(F.lit(1))
    elif kind == "count_col":
        e = F.count(col)
    elif kind == "count_distinct":
        e = F.count_distinct(col)
    elif kind == "sum":
        e = F.sum(col)
    elif kind == "avg":
        e = F.avg(col)
    elif kind == "min":
        e = F.min(col)
    elif kind == "max":
        e = F.max(col)
    else:
        raise ValueError(f"unknown aggregate: {kind}")
    if kind.startswith("count"):
        e = e.cast("long")
    return e.alias(alias)


def default_alias(kind: str, col: str | None) -> str:
    """C8 default names: avg_x, sum_x, min_x, max_x, count, count_x, count_distinct_x."""
    if kind == "count":
        return "count"
    if kind == "count_col":
        return f"count_{col}"
    return f"{kind}_{col}"


def exact_agg(df: DataFrame, aggs, by: str | Sequence[str] | None = None, where=None) -> DataFrame:
    """Exact aggregates; ``aggs`` = [(kind, column, alias or None)]."""
    by = as_list(by)
    if where is not None:
        df = df.where(where)
    exprs = [agg_expr(k, c, a or default_alias(k, c)) for k, c, a in aggs]
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def first_per_group(df: DataFrame, by, column: str, order_key: str) -> DataFrame:
    """A non-aggregated item under GROUP BY -> the value at the smallest key (deterministic)."""
    return df.groupBy(*as_list(by)).agg(F.min_by(column, order_key).alias(column))


def finite_values(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Coerce to double and drop NULL, NaN and +-Inf."""
    v = F.expr(f"try_cast(`{column}` as double)")
    name = out or column
    return df.withColumn(name, v).where(F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(name) < F.lit(float("inf"))))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, max, sum per numeric column in ONE pass, one row per column."""
    cols = list(columns) if columns else numeric_columns(df)
    exprs = []
    for c in cols:
        x = F.col(c).cast("double")
        exprs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).cast("long").alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
                F.sum(x).alias("sum"),
            ).alias(c)
        )
    wide = df.agg(*exprs)
    return wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("p")).select("p.*")


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """Value -> count, largest first (ties by value)."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).cast("long").alias("frequency"))
        .orderBy(F.col("frequency").desc(), F.col(column))
    )


def stratum_summary(population: DataFrame, sample: DataFrame, by, value: str) -> DataFrame:
    """Per stratum count/mean/std of the population beside the sample (inner join on keys)."""
    by = as_list(by)

    def stats(d, p):
        return d.groupBy(*by).agg(
            F.count(F.lit(1)).cast("long").alias(f"{p}_count"),
            F.avg(value).alias(f"{p}_mean"),
            F.stddev_samp(value).alias(f"{p}_std"),
        )

    return join_keys(stats(population, "pop"), stats(sample, "sample"), by)
