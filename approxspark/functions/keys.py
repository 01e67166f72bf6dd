"""Deterministic per-row priorities.

Every sampler ranks rows by ``md5(seed ':' key)`` (hex string, ties broken by the key string).
The same expression exists in DuckDB, so every sample is reproducible across engines and
checkable by value hash. Only integer and string keys are hashed (never doubles).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296
TWO_POW_60 = 1 << 60
# text of a NULL key part: NULL is a key value of its own
NULL_TEXT = "\\N"


def as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def key_string(key: str | Sequence[str]) -> Column:
    """The key as text; several columns are joined with '|', a NULL part has a text of its own.

    Different keys may share a text; that only ties their priorities, which samplers break by the row.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in as_list(key)]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def priority(key: str | Sequence[str], seed: int, salt: str | None = None) -> Column:
    """md5 hex of 'seed:key' (or 'seed:salt:key')."""
    prefix = f"{seed}:" if salt is None else f"{seed}:{salt}:"
    return F.md5(F.concat(F.lit(prefix), key_string(key)))


def hex_threshold(v: int) -> str:
    """Threshold on the 32-bit prefix as text: ``prio < hex_threshold(v)`` iff prefix(prio) < v.

    md5 hex is lower-case, so string order equals numeric order; comparing the 32-char priority
    with an 8-char bound needs no decoding (much cheaper than ``conv`` per row). v >= 2^32 -> 'g'
    (above every hex digit, keeps all rows).
    """
    if v >= TWO_POW_32:
        return "g"
    return format(max(0, v), "08x")


def uniform(prio: Column) -> Column:
    """Uniform double in (0, 1) from the first 60 bits: (v + 0.5) / 2^60."""
    return (F.conv(F.substring(prio, 1, 15), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(TWO_POW_60))


# SQL text of the same expressions, used by the DuckDB oracles.
def sql_key(key: str | Sequence[str]) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_TEXT}')" for c in as_list(key)]
    return parts[0] if len(parts) == 1 else "concat_ws('|', " + ", ".join(parts) + ")"


def sql_priority(key: str | Sequence[str], seed: int, salt: str | None = None) -> str:
    prefix = f"{seed}:" if salt is None else f"{seed}:{salt}:"
    return f"md5('{prefix}' || {sql_key(key)})"


def sql_uniform(prio_sql: str) -> str:
    return f"((('0x' || substr({prio_sql}, 1, 15))::BIGINT + 0.5) / {float(TWO_POW_60)!r})"
