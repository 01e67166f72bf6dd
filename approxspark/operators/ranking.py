"""Global ranks without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "_rank") -> DataFrame:
    """``df`` with a 0-based rank by ``order``, written to the shared folder.

    Rows are dealt to ranges of the order (ties by a hash of the whole row, so that one hot value is
    split too) and sorted within each; a row's rank is its place in its range plus the sizes of the
    ranges before it, of which there are as many as shuffle partitions.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [*order, tie]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed, _ = store(placed, "ranked")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = placed.withColumn("_part", part).join(offsets, "_part")
    return ranked.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_at", "_before")


def prefix_sums(df: DataFrame, order: Sequence[str | Column], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with, for each name, the sum of a column over all rows before it in ``order``.

    As :func:`global_rank`: rows are dealt to ranges and summed within each; the ranges' totals are
    summed over as many rows as there are ranges.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    placed = df.withColumns({f"_add{name}": c for name, c in sums.items()}).repartitionByRange(*order, tie).sortWithinPartitions(*order, tie)
    placed, _ = store(placed.withColumn("_at", F.monotonically_increasing_id()), "prefix")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    ahead = Window.unboundedPreceding, -1
    totals = placed.groupBy("_part").agg(*[F.sum(f"_add{name}").alias(f"_all{name}") for name in sums])
    before = totals.select("_part", *[F.coalesce(F.sum(f"_all{name}").over(Window.orderBy("_part").rowsBetween(*ahead)), F.lit(0)).alias(f"_before{name}") for name in sums])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(*ahead)
    summed = placed.withColumns({name: F.coalesce(F.sum(f"_add{name}").over(inside), F.lit(0)) for name in sums}).join(before, "_part")
    return summed.withColumns({name: F.col(name) + F.col(f"_before{name}") for name in sums}).select(*df.columns, *sums)
