"""Registered queries: each name maps to a Spark callable (spark, sf_dir) -> DataFrame and, where
the operator is SQL-expressible, an equivalent DuckDB SQL text over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def rounded(df, **digits: int):
    """``df`` with the named columns rounded: sums of doubles differ in their last bits between engines,
    so queries round where they are compared; operators never do."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def load_all() -> None:
    from . import approximate_q, bounds_q, evaluate_q, exact_q, sampling_q, sketches_q, sources_q, streaming_q  # noqa: F401
