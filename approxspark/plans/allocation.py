"""Sampling plans: how many rows each stratum contributes.

A plan is a small DataFrame with one row per stratum: the stratum key(s), ``pop_n`` (population
rows after any filter) and ``take_n`` (rows to draw). It is built from one ``groupBy`` pass over the
input (partial aggregation on the map side, so a hot stratum costs nothing extra) and then
computed on the strata table only; its size is the number of strata, never the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import as_list
from ..operators.joins import join_keys
from ..operators.ranking import global_rank, prefix_sums
from ..session import store

#: Strata that a single task may pick out; more are picked by their ranks.
TOP = 10_000
RULES = ("proportional", "proportional_spread", "neyman", "equal", "min_one")


def strata_sizes(df: DataFrame, by: str | Sequence[str], value_col: str | None = None) -> DataFrame:
    """``by`` columns, ``pop_n`` and (with ``value_col``) the stratum's sample std ``pop_sd``."""
    by = as_list(by)
    aggs = [F.count(F.lit(1)).alias("pop_n")]
    if value_col is not None:
        aggs.append(F.stddev_samp(value_col).alias("pop_sd"))
    return df.groupBy(*by).agg(*aggs)


def allocate(sizes: DataFrame, k: int, by: str | Sequence[str], rule: str = "proportional", stored: bool = False, total: int | None = None) -> DataFrame:
    """Add ``take_n`` to a strata-sizes table; NULL is a stratum.

    proportional         floor(k pop_n / N); the whole remainder goes to the largest stratum
    proportional_spread  floor(k pop_n / N); the remainder one each to the largest strata
    neyman               floor(k pop_n pop_sd / sum N s); remainder to the largest stratum;
                         NULL pop_sd counts as 0; all-zero s falls back to proportional
    equal                k / H each; the remainder one each to the first strata by key
    min_one              max(1, floor(k pop_n / N))

    No stratum gives more than it has. A stratum whose share is all of it or more is full; what it can't
    give is shared by the same rule among the others, so that k rows are placed or none is left (min_one,
    whose total is not k, only caps). The remainder is that of the strata that aren't full: the largest takes
    what it has room for, and the next largest one each of the rest. Ties for "largest" are broken by the greater key.

    Which strata are full follows from one pass in the order of pop_n / weight with prefix sums
    (``ranking.prefix_sums``); where no share can reach its stratum's size, not even that is needed.
    The rest are scalar aggregates of the strata table; nothing puts the whole of it into one task. It is written
    first, unless the caller says that it comes from a ``stored`` table (:func:`samplers.sizes_of`), from which it is cheap. ``total`` is the number of all rows, where it is known.
    """
    if rule not in RULES:
        raise ValueError(f"unknown allocation rule: {rule}")
    if k < 0:
        raise ValueError("sample size must be non-negative")
    by = as_list(by)
    strata = sizes.withColumn("pop_n", F.col("pop_n").cast("long"))
    if not stored:
        strata, _ = store(strata, "strata")
    pop = F.col("pop_n")
    if rule == "min_one":
        if total is None:
            total = strata.agg(F.sum("pop_n")).first()[0]
        return strata.withColumn("take_n", F.least(pop, F.greatest(F.lit(1).cast("long"), F.floor(F.lit(k).cast("long") * pop / F.lit(total or 1)))))
    spread = F.coalesce(F.col("pop_sd"), F.lit(0.0)) if rule == "neyman" else F.lit(1.0)
    strata = strata.withColumn("_w", F.lit(1.0) if rule == "equal" else pop * spread)
    g = strata.agg(F.sum("pop_n").alias("N"), F.sum("_w").alias("W"), F.max(F.col("_w") / pop).alias("steep")).first()
    k = min(k, g["N"] or 0)
    if not k:
        return strata.withColumn("take_n", F.lit(0).cast("long")).drop("_w")
    if not g["W"]:  # no stratum varies
        strata, g = strata.withColumn("_w", pop.cast("double")), {"N": g["N"], "W": float(g["N"]), "steep": 1.0}
    if k * g["steep"] > g["W"]:  # some share may pass its stratum's size
        strata = prefix_sums(strata, [F.when(F.col("_w") > 0, pop / F.col("_w")).asc_nulls_last(), *by], {"_pops": pop, "_ws": F.col("_w")})
        # at the level at which a stratum is just full: what the earlier ones have, and the share of all others
        full = (F.col("_w") > 0) & (F.col("_pops") + pop / F.col("_w") * (F.lit(g["W"]) - F.col("_ws")) <= k)
        strata = strata.withColumn("_full", full)
        open_ = ~F.col("_full")
        left = strata.agg(F.coalesce(F.sum(F.when(F.col("_full"), pop)), F.lit(0)).alias("k"), F.sum(F.when(open_, F.col("_w"))).alias("W"), F.sum(F.when(open_, pop)).alias("N")).first()
    else:
        strata, left = strata.withColumn("_full", F.lit(False)), {"k": 0, "W": g["W"], "N": g["N"]}
    rest = k - left["k"]
    if not rest:
        return strata.withColumn("take_n", F.when(F.col("_full"), pop).otherwise(F.lit(0)).cast("long")).select(*sizes.columns, "take_n")
    # strata that don't vary share what the full ones leave, if no others are open
    weight, total = (F.col("_w"), left["W"]) if left["W"] else (pop, left["N"])
    share = F.floor(F.lit(rest).cast("long") * weight / F.lit(total))
    strata = strata.withColumn("take_n", F.when(F.col("_full"), pop).otherwise(share).cast("long")).select(*sizes.columns, "_full", "take_n")
    more = k - strata.agg(F.sum("take_n")).first()[0]
    return _add_remainder(strata, more, by, rule).select(*sizes.columns, "take_n")


def _add_remainder(strata: DataFrame, more: int, by: Sequence[str], rule: str) -> DataFrame:
    """Place ``more`` rows in strata that aren't full: fewer than there are of these, each with room for one at least."""
    if more <= 0:
        return strata
    by_size = [F.col("pop_n").desc(), *[F.col(c).desc() for c in by]]
    order = [F.col(c).asc() for c in by] if rule == "equal" else by_size
    rows = strata.where(~F.col("_full")).select(*by, "pop_n", (F.col("pop_n") - F.col("take_n")).alias("_room"))
    first = 1
    if rule in ("proportional", "neyman"):
        first = min(more, rows.orderBy(*by_size).select("_room").first()[0])
    n = 1 + more - first  # strata that get some
    top = rows.orderBy(*order).limit(n) if n <= TOP else global_rank(rows, order).where(F.col("_rank") < n)
    top = top.select(*by, F.lit(1).alias("_extra"))
    given = join_keys(strata, top, by, "left")
    if first > 1:
        largest = rows.orderBy(*by_size).limit(1).select(*by, F.lit(first - 1).alias("_first"))
        given = join_keys(given, largest, by, "left")
        return given.withColumn("take_n", F.col("take_n") + F.coalesce("_extra", F.lit(0)) + F.coalesce("_first", F.lit(0)))
    return given.withColumn("take_n", F.col("take_n") + F.coalesce("_extra", F.lit(0)))
