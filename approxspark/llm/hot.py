"""Joins on a key that a large share of the rows may have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

#: A key of a thousandth of all rows or more is joined in parts of about so many rows.
PART = 2_000
#: Parts of the rows whose key is null.
NULLS = 64


def left_join(rows: DataFrame, found: DataFrame, key: str, total: int, row: str = "row") -> DataFrame:
    """Left join of ``rows`` with ``found``, which has a key once. ``total`` is the number of rows, ``row`` a long that tells them apart.

    Keys of at least a thousandth of the rows are at most a thousand, so small that every task can have them:
    their rows are dealt to parts, and what was found is repeated for each part.
    """
    hot = rows.groupBy(key).count().where((F.col("count") * 1000 >= total) & (F.col("count") > PART))
    hot, _ = store(hot.select(key, F.ceil(F.col("count") / PART).cast("int").alias("_parts")), "hot")
    parts = F.coalesce("_parts", F.lit(1))
    spread = F.when(F.col(key).isNull(), NULLS).otherwise(parts)  # a null key finds nothing, wherever it is
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("_part", F.pmod(F.xxhash64(row), spread).cast("int")).drop("_parts")
    found = found.join(F.broadcast(hot), key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return rows.join(found, [key, "_part"], "left").drop("_part")
