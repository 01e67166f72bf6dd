"""Approximate aggregation from samples.

Each aggregate is a tuple ``(kind, column, alias)``, kind one of
``count`` (COUNT(*)), ``count_col``, ``count_distinct``, ``sum``, ``avg``, ``min``, ``max``.

NULL is a group like any other. A sampled row stands for ``pop_n / take_n`` rows of its stratum: COUNT is the
sum of these weights, SUM that of weight times value, AVG their quotient (Horvitz-Thompson totals), so
that any group and any predicate is answered from any sample, whether or not the groups are the
strata; MIN / MAX are the sample's. Intervals come from the linearised variance of totals and ratios within
strata. DISTINCT counts never come from the sample (biased); they are HLL sketches over the whole
filtered table, joined on the group keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import as_list
from ..functions.stats import z_value
from ..plans.allocation import allocate
from ..plans.sizing import ci_z, size_for_accuracy
from ..session import store
from . import samplers
from .joins import join_keys

KINDS = ("count", "count_col", "count_distinct", "sum", "avg", "min", "max")
HLL_LG_K = 14
NOT_THE_SAMPLE = "the sample doesn't hold take_n rows of each of these strata"


def _check(aggs):
    for kind, _col, _alias in aggs:
        if kind not in KINDS:
            raise ValueError(f"unknown aggregate: {kind}")


def _estimates(aggs, alike: bool) -> list[Column]:
    """Aggregates over sampled rows by weight. ``alike``: all rows of a group have one weight, which is then
    applied to the group's total."""
    weight = F.col("pop_n") / F.col("take_n")
    of_all = F.max("pop_n") / F.max("take_n")

    def total(x: Column) -> Column:
        return F.sum(x) * F.max("pop_n") / F.max("take_n") if alike else F.sum(x * weight)

    def rows(known: Column | None) -> Column:
        some = F.lit(1) if known is None else F.when(known, 1)
        # whole numbers up to the rounding of the weights
        return F.floor(F.round(F.count(some) * of_all if alike else F.coalesce(F.sum(some * weight), F.lit(0.0)), 6)).cast("long")

    out = []
    for kind, col, alias in aggs:
        x = F.col(col) if col else None
        if kind in ("count", "count_col"):
            e = rows(None if kind == "count" else x.isNotNull())
        elif kind == "sum":
            e = total(x)
        elif kind == "avg":
            e = F.avg(x) if alike else F.sum(x * weight) / F.sum(F.when(x.isNotNull(), weight))
        elif kind in ("min", "max"):
            e = getattr(F, kind)(x)
        else:
            continue
        out.append(e.alias(alias))
    return out


def _with_intervals(rows: DataFrame, aggs, by: Sequence[str], strata: Sequence[str], confidence: float) -> DataFrame:
    """Keys, _n, aggregates and <alias>_lower / <alias>_upper of COUNT, SUM and AVG.

    With z the value of a row in the group and 0 elsewhere, a total's variance is the sum over strata of
    N (N - n) / n times the variance of z within the stratum; a ratio's is that of z - R d over the squared
    denominator. The moments per group and stratum are summed in one aggregate; R, known only per group, is
    multiplied out. A stratum that was not drawn whole and holds a single row has no variance: no interval.
    """
    num = lambda c: F.col(c).cast("double")
    columns = list(dict.fromkeys(c for kind, c, _ in aggs if c and kind in ("count_col", "sum", "avg")))
    moments = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        moments += [F.count(c).alias(f"_m{i}"), F.sum(num(c)).alias(f"_s{i}"), F.sum(num(c) * num(c)).alias(f"_q{i}")]
    for i, (kind, c, _) in enumerate(aggs):
        if kind in ("min", "max"):
            moments.append(getattr(F, kind)(c).alias(f"_e{i}"))
    cells = rows.groupBy(*by, *[c for c in strata if c not in by], "pop_n", "take_n").agg(*moments)
    N, n = F.col("pop_n").cast("double"), F.col("take_n").cast("double")
    w = N / n
    a = F.when(N <= n, 0.0).when(n > 1, N * (N - n) / (n * (n - 1)))
    parts = [F.sum("_n").alias("_n"), F.sum(w * F.col("_n")).alias("_W"), F.sum(a * (F.col("_n") - F.col("_n") * F.col("_n") / n)).alias("_VW"),
             F.max(a.isNull().cast("int")).alias("_unknown"), F.max((N > n).cast("int")).alias("_part")]
    for i in range(len(columns)):
        m, q = F.col(f"_m{i}"), F.col(f"_q{i}")
        sm = F.coalesce(F.col(f"_s{i}"), F.lit(0.0))
        q = F.coalesce(q, F.lit(0.0))
        parts += [F.sum(w * F.col(f"_s{i}")).alias(f"_S{i}"), F.sum(w * m).alias(f"_M{i}"), F.sum(a * (q - sm * sm / n)).alias(f"_A{i}"),
                  F.sum(a * (sm - sm * m / n)).alias(f"_B{i}"), F.sum(a * (m - m * m / n)).alias(f"_C{i}")]
    for i, (kind, _, _) in enumerate(aggs):
        if kind in ("min", "max"):
            parts.append(getattr(F, kind)(f"_e{i}").alias(f"_e{i}"))
    groups = cells.groupBy(*by).agg(*parts)
    z = F.lit(z_value(confidence / 100.0))
    out = []
    for i, (kind, c, alias) in enumerate(aggs):
        if kind in ("min", "max"):
            out.append(F.col(f"_e{i}").alias(alias))
            continue
        if kind == "count_distinct":
            continue
        j = columns.index(c) if kind != "count" else 0
        A, B, C, R = F.col(f"_A{j}"), F.col(f"_B{j}"), F.col(f"_C{j}"), F.col(f"_S{j}") / F.col(f"_M{j}")
        est, var = {"count": lambda: (F.coalesce("_W", F.lit(0.0)), F.col("_VW")), "count_col": lambda: (F.coalesce(f"_M{j}", F.lit(0.0)), C), "sum": lambda: (F.col(f"_S{j}"), A),
                    "avg": lambda: (R, (A - 2 * R * B + R * R * C) / (F.col(f"_M{j}") * F.col(f"_M{j}")))}[kind]()
        half = F.when(F.col("_unknown") == 0, z * F.sqrt(F.greatest(var, F.lit(0.0))))
        shown = F.floor(F.round(est, 6)).cast("long") if kind.startswith("count") else est
        out += [shown.alias(alias), (est - half).alias(f"{alias}_lower"), (est + half).alias(f"{alias}_upper")]
    return groups.select(*by, "_n", "_part", *out)


def estimate(sample: DataFrame, aggs, by: str | Sequence[str] | None = None, strata: str | Sequence[str] | None = None,
             where: Column | str | None = None, confidence: int = 95, intervals: bool = False, total: int | None = None) -> DataFrame:
    """Aggregates of the table that ``sample`` was drawn from, for any group keys and any predicate.

    Sampled rows carry their stratum's ``pop_n`` and ``take_n``. ``strata`` names the columns that the sample
    was stratified by ([] for a simple sample); without it estimates are the same, but there are no ``intervals`` and
    a group only counts as complete when the whole sample is. Pass predicates as ``where``: a sample filtered
    beforehand no longer holds ``take_n`` rows of a stratum, and with ``strata`` that is refused. Groups and
    predicates that meet no sampled row give no row (without ``by``: COUNT 0, other aggregates NULL).

    Output: keys, aggregates, with ``intervals`` their <alias>_lower and <alias>_upper, and the envelope.
    """
    _check(aggs)
    if any(kind == "count_distinct" for kind, _c, _a in aggs):
        raise ValueError("distinct counts come from the HLL synopsis, not from a sample")
    if intervals and strata is None:
        raise ValueError("intervals need the sample's strata ([] for a simple sample)")
    by, known = as_list(by), strata is not None
    strata = as_list(strata)
    pop, take = F.col("pop_n"), F.col("take_n")
    own = known and set(strata) <= set(by)  # a group lies within one stratum, and its rows weigh the same
    rows = sample if where is None else sample.where(where)
    total_of_all = F.coalesce(F.round(F.sum(pop / take)).cast("long"), F.lit(0))
    if intervals:
        res = _with_intervals(rows, aggs, by, strata, confidence).withColumnRenamed("_n", "sample_size")
    else:
        res = rows.groupBy(*by).agg(*_estimates(aggs, own), F.count(F.lit(1)).alias("sample_size"), F.max((pop > take).cast("int")).alias("_part"), total_of_all.alias("_total"), F.max(take).alias("_take"))
    if not by and not strata and where is None and not intervals:
        # the one row tells of the whole sample
        told = F.when(F.lit(known) & (F.col("sample_size") != F.col("_take")), F.raise_error(F.lit(NOT_THE_SAMPLE))).otherwise(F.col("_total"))
        res = res.withColumn("_whole", F.struct(told.alias("total"), F.coalesce("_part", F.lit(0)).alias("part")))
    elif known:
        drawn = sample.groupBy(*strata, "pop_n", "take_n").agg(F.count(F.lit(1)).alias("_rows"))
        ok = F.when(F.col("_rows") != take, F.raise_error(F.lit(NOT_THE_SAMPLE))).otherwise(pop)
        whole = drawn.agg(F.struct(F.coalesce(F.sum(ok), F.lit(0)).alias("total"), F.coalesce(F.max((pop > take).cast("int")), F.lit(0)).alias("part")))
        res = res.withColumn("_whole", whole.scalar())
    else:
        whole = sample.agg(F.struct(total_of_all.alias("total"), F.coalesce(F.max((pop > take).cast("int")), F.lit(0)).alias("part")))
        res = res.withColumn("_whole", whole.scalar())
    complete = F.col("_part" if own else "_whole.part") == 0
    res = _envelope(res, confidence, F.coalesce(complete, F.lit(False)), F.col("_whole.total") if total is None else F.lit(total).cast("long"))
    kept = [c for _k, _c, alias in aggs for c in ([alias, f"{alias}_lower", f"{alias}_upper"] if intervals and _k not in ("min", "max") else [alias])]
    return res.select(*by, *kept, *ENVELOPE)


def distinct_sketch(df: DataFrame, aggs, by: Sequence[str]) -> DataFrame | None:
    """HLL estimates of every DISTINCT aggregate over the full (filtered) table."""
    exprs = [
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col(col), HLL_LG_K)).alias(alias)
        for kind, col, alias in aggs
        if kind == "count_distinct"
    ]
    if not exprs:
        return None
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def approx_agg(
    df: DataFrame,
    aggs,
    by: str | Sequence[str] | None = None,
    where: Column | str | None = None,
    accuracy: float = 95,
    confidence: int = 95,
    key: str | Sequence[str] = "id",
    seed: int = 42,
    sample_size: int | None = None,
    min_sample: int | None = None,
    max_sample: int | None = None,
    intervals: bool = False,
) -> DataFrame:
    """Approximate aggregate query with the result envelope.

    WHERE is applied first (population N counts filtered rows). Sample size from the accuracy
    target (D14, within ``min_sample`` and ``max_sample`` if given) unless ``sample_size`` is given;
    confidence picks z for the relative half-width ``ci`` = z/sqrt(n_g) only. Grouped queries draw a
    stratified sample on the group keys with max(1, k N_g/N) rows per group (E8). A sample that holds
    every row (of a group) answers exactly (D18: ``approx`` false, ``ci`` 0) by the same plan; DISTINCT
    always comes from the sketch. ``intervals`` adds <alias>_lower and <alias>_upper to COUNT, SUM and AVG.

    Output columns: keys, aggregates, ``approx`` (bool), ``ci``, ``sample_size``, ``total_size``.
    """
    _check(aggs)
    by = as_list(by)
    if where is not None:
        df = df.where(where)

    def size(n: int) -> int:
        return min(n, sample_size) if sample_size is not None else size_for_accuracy(accuracy, n, min_sample, max_sample)

    shown = [a for a in aggs if a[0] != "count_distinct"]
    if by:
        hist = samplers.histogram(df, by, key, seed)
        N = hist.agg(F.sum("_n")).first()[0] or 0
        plan = allocate(samplers.sizes_of(hist, by), size(N), by, "min_one", stored=True, total=N)
        sample = samplers.from_plan(df, plan, by, key, seed, hist)
    else:
        sample, n, N = samplers.sized_random(df, size, key, seed)
        sample = sample.withColumns({"pop_n": F.lit(N).cast("long"), "take_n": F.lit(n).cast("long")})
    if intervals:
        # the strata are checked against the sample, so that it is read twice: write it
        sample, _ = store(sample, "sample")
        res = estimate(sample, shown, by, by, None, confidence, True, N)
    else:
        res = sample.groupBy(*by).agg(*_estimates(shown, True), F.count(F.lit(1)).alias("sample_size"), F.max("pop_n").alias("_pop"))
        covered = F.col("sample_size") >= F.col("_pop") if by else F.lit(n >= N)
        res = _envelope(res, confidence, covered, F.lit(N).cast("long"))
    sketches = distinct_sketch(df, aggs, by)
    if sketches is not None and by:
        res = join_keys(res, sketches, by, "left")
    elif sketches is not None:
        # ungrouped: the sketch estimates are scalars
        est = sketches.first().asDict()
        res = res.withColumns({name: F.lit(v).cast("long") for name, v in est.items()})
    ends = [f"{a}_{end}" for k, _c, a in shown for end in ("lower", "upper") if intervals and k not in ("min", "max")]
    return res.select(*by, *[a for _k, _c, a in aggs], *ends, *ENVELOPE)


ENVELOPE = ["approx", "ci", "sample_size", "total_size"]


def _envelope(res: DataFrame, confidence: int, covered: Column, total: Column) -> DataFrame:
    return res.withColumns({
        "approx": ~covered,
        "ci": F.when(covered, F.lit(0.0)).otherwise(F.lit(ci_z(confidence)) / F.sqrt(F.col("sample_size"))),
        "total_size": total,
    })


def sampled_scalar(df: DataFrame, aggs, k: int, key, seed: int = 42, by: str | Sequence[str] | None = None) -> DataFrame:
    """SUM / COUNT scaled by N / n, AVG / MIN / MAX unscaled, over a simple random sample of n = min(k, N)
    rows, in total or per group of ``by``.

    COUNT and the distinct count by ratio (kept for parity; biased upward) are truncated to integers as in the reference.
    """
    sample, n, N = samplers.sized_random(df, lambda total: min(k, total), key, seed)
    n = max(1, n)
    out = []
    for kind, col, alias in aggs:
        if kind == "count":
            out.append(F.floor(F.count(F.lit(1)) * F.lit(N) / F.lit(n)).cast("long").alias(alias))
        elif kind == "sum":
            out.append((F.sum(col) * F.lit(N) / F.lit(n)).alias(alias))
        elif kind == "avg":
            out.append(F.avg(col).alias(alias))
        elif kind in ("min", "max"):
            out.append(getattr(F, kind)(col).alias(alias))
        elif kind == "count_distinct":
            out.append(F.floor(F.count_distinct(col) / F.lit(n) * F.lit(N)).cast("long").alias(alias))
    return sample.groupBy(*as_list(by)).agg(*out)


def approx_select(df: DataFrame, columns: Sequence[str], k: int, key, seed: int = 42, where=None) -> DataFrame:
    """Approximate SELECT without aggregates returns the sample rows."""
    if where is not None:
        df = df.where(where)
    return samplers.simple_random(df, k, key, seed).select(*columns)


def approx_agg_from_sample(sample: DataFrame, aggs, by: str | Sequence[str] | None = None, confidence: int = 95,
                           strata: str | Sequence[str] | None = None, where: Column | str | None = None, intervals: bool = False) -> DataFrame:
    """Aggregates answered from a stored sample synopsis, without the base table: see :func:`estimate`."""
    return estimate(sample, aggs, by, strata, where, confidence, intervals)
