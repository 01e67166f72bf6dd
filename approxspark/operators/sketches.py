"""Distinct-count and frequency sketches.

HLL: Spark's built-in mergeable sketch (``hll_sketch_agg`` / ``hll_union_agg`` /
``hll_sketch_estimate``), lgConfigK 14 as the reference's p = 14.

Count-Min: kept *relational* - a table (depth_row, bucket, cnt) - so it can be built by one plain
``groupBy`` (map-side partial aggregation leaves at most depth x width rows per task to shuffle,
whatever the keys; the depth rows' hashes are seeded digests of their own or parts of shared ones), NULL being a key of its own, merged by ``union`` + ``groupBy``, maintained by a streaming aggregate and probed by a
join. Buckets use an md5 hash so DuckDB reproduces the same table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import NULL_TEXT, as_list

# Fixed values that must equal the reference's behaviour:
# HLL precision p = 14; Count-Min width 2000 x depth 5
HLL_LG_K = 14
CMS_WIDTH = 2000
CMS_DEPTH = 5


def hll_estimate(df: DataFrame, column: str, by: str | Sequence[str] | None = None, alias: str = "approx_distinct") -> DataFrame:
    """HLL distinct estimate (per group with ``by``)."""
    e = F.hll_sketch_estimate(F.hll_sketch_agg(F.col(column), HLL_LG_K)).alias(alias)
    by = as_list(by)
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def hll_sketches(df: DataFrame, column: str, part: str | Sequence[str]) -> DataFrame:
    """One binary sketch per part (batch, day, file...)."""
    return df.groupBy(*as_list(part)).agg(F.hll_sketch_agg(F.col(column), HLL_LG_K).alias("sketch"))


def hll_merge(sketches: DataFrame, by: str | Sequence[str] | None = None, alias: str = "approx_distinct") -> DataFrame:
    """Union the sketches of parts and estimate."""
    e = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(alias)
    by = as_list(by)
    return sketches.groupBy(*by).agg(e) if by else sketches.agg(e)


#: Depth rows that one digest serves unless told otherwise, six hex digits each; 1 hashes the key anew, by its own seed, for each.
PER_DIGEST = 5


def _digits(per_digest: int) -> int:
    """Hex digits of a digest that each of its depth rows has: 32 bits if they are there."""
    return min(8, 32 // per_digest)


def _cells(df: DataFrame, by: Sequence[str], key: Column, width: int, depth: int, per_digest: int, *more: Column) -> DataFrame:
    """Each row once per depth row with its bucket: bits of a digest of the key, which serves ``per_digest`` rows, mod width."""
    text = F.coalesce(key.cast("string"), F.lit(NULL_TEXT))
    digests = [F.md5(F.concat(F.lit(f"{i}:"), text)).alias(f"_d{i}") for i in range(-(-depth // per_digest))]
    df = df.select(*by, *more, *digests)
    n = _digits(per_digest)
    bits = lambda r: F.conv(F.substring(f"_d{r // per_digest}", n * (r % per_digest) + 1, n), 16, 10).cast("bigint")
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("depth_row"), (bits(r) % F.lit(width)).cast("int").alias("bucket")) for r in range(depth)]))
    return df.select(*by, *[c for c in df.columns if c not in by and not c.startswith("_d")], each.alias("_cell")).select("*", "_cell.*").drop("_cell")


def cms_bucket_sql(row: str, key: str, width: int = CMS_WIDTH, per_digest: int = PER_DIGEST) -> str:
    """The same bucket in DuckDB, for the oracles."""
    n, text = _digits(per_digest), f"coalesce(CAST({key} AS VARCHAR), '{NULL_TEXT}')"
    if per_digest == 1:
        return f"(('0x' || substr(md5(CAST({row} AS VARCHAR) || ':' || {text}), 1, {n}))::BIGINT % {width})::INTEGER"
    digest = f"md5(CAST({row} // {per_digest} AS VARCHAR) || ':' || {text})"
    return f"(('0x' || substr({digest}, CAST({n} * ({row} % {per_digest}) + 1 AS BIGINT), {n}))::BIGINT % {width})::INTEGER"


def cms_build(df: DataFrame, key: str, count: str | None = None, width: int = CMS_WIDTH, depth: int = CMS_DEPTH,
              by: str | Sequence[str] | None = None, per_digest: int = PER_DIGEST) -> DataFrame:
    """Count-Min table (depth_row, bucket, cnt); ``count`` adds a weight column instead of 1;
    ``by`` builds one table per value of those columns (e.g. one per profiled column) in one pass;
    with ``per_digest`` 1 each depth row has a seeded hash of its own, as in the reference."""
    by = as_list(by)
    c = F.col(count).cast("long") if count else F.lit(1).cast("long")
    return _cells(df, by, F.col(key), width, depth, per_digest, c.alias("_c")).groupBy(*by, "depth_row", "bucket").agg(F.sum("_c").cast("long").alias("cnt"))


def cms_merge(*tables: DataFrame, by: str | Sequence[str] | None = None) -> DataFrame:
    """Merge Count-Min tables of parts: cell-wise sum."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy(*as_list(by), "depth_row", "bucket").agg(F.sum("cnt").cast("long").alias("cnt"))


def tracked_for(share: float) -> int:
    """Keys that a frequent-items summary has to track for every key of more than ``share`` of all rows to be in it.

    Its counts are off by at most 3.5 / m of all rows for a table of m (a power of two, filled to three quarters), and it
    names the keys whose count is above that for sure: those of more than 7 / m of all rows.
    """
    return int(0.75 * 2 ** math.ceil(math.log2(7.0 / share)))


def heavy_sketch(column: str, share: float) -> Column:
    """Aggregate: a mergeable frequent-items summary of a column's values as text (NULL being one), of bounded size."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(NULL_TEXT))
    return F.call_function("approx_top_k_accumulate", text, F.lit(tracked_for(share)))


def heavy_merge(sketch: str, share: float) -> Column:
    """Aggregate: the summary of the union of the parts' summaries."""
    return F.call_function("approx_top_k_combine", F.col(sketch), F.lit(tracked_for(share)))


def heavy_keys(sketches: DataFrame, sketch: str, share: float, alias: str = "key") -> DataFrame:
    """The keys that a table of one summary names, NULL as such; every key of more than ``share`` of the rows is among them."""
    items = F.call_function("approx_top_k_estimate", F.col(sketch), F.lit(tracked_for(share)))
    return sketches.select(F.explode(items).alias("_i")).select(F.nullif(F.col("_i.item"), F.lit(NULL_TEXT)).alias(alias))


def cms_estimate(keys: DataFrame, key: str, table: DataFrame, width: int = CMS_WIDTH, depth: int = CMS_DEPTH,
                 alias: str = "estimate", per_digest: int = PER_DIGEST) -> DataFrame:
    """Point estimate per key = min over depth rows of its bucket's count (never below the truth).

    The CMS table has depth x width rows, so Spark may broadcast it; NULL keys are probed like others.
    Width, depth and ``per_digest`` are those that the table was built with.
    """
    probes = _cells(keys.select(F.col(key)).distinct(), [key], F.col(key), width, depth, per_digest)
    j = probes.join(table.select("depth_row", "bucket", "cnt"), ["depth_row", "bucket"], "left")
    return j.groupBy(key).agg(F.coalesce(F.min("cnt"), F.lit(0)).cast("long").alias(alias))
