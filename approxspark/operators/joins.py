"""Joins on strata and row keys in which NULL is a value like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import as_list


def join_keys(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL matching NULL; the keys appear once, from the left side.

    No side is forced: Spark broadcasts one whose size it knows to be small and sorts otherwise.
    """
    keys = as_list(on)
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in keys})
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in keys])
    return left.join(right, cond, how).drop(*[f"_right_{c}" for c in keys])
