"""Synopsis tables (D1, D19, D20): the reference's constructor cache, rebuilt as explicit Spark jobs
that write parquet tables into the shared checkpoint folder. Later queries read the tables
instead of the base data.

profile   one aggregate pass: per numeric column count/mean/std/min/max/sum, plus value
          frequencies of each categorical column and the table's total row count
sketches  one aggregate pass with an HLL sketch per column (wide row, then unpivoted), a Count-Min
          table per categorical column and bottom-k samples
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.allocation import allocate
from ..plans.sizing import size_for_accuracy
from ..session import scratch_path, store
from . import samplers
from .exact import numeric_columns
from .sketches import HLL_LG_K, cms_build, cms_estimate, cms_merge, heavy_keys, heavy_merge, heavy_sketch

def profile(df: DataFrame, frequencies: Sequence[str]) -> DataFrame:
    """D19 as a DataFrame: rows (column, kind, value, count, mean, std, min, max, sum).

    kind = 'rows' (total row count), 'numeric' (one row per numeric column) or 'frequency'
    (one row per value of each column of ``frequencies``: the caller names them, as a near-unique
    column's table is as large as the data). The numeric part is a single aggregate; the frequency
    tables are a ``groupBy`` with map-side partial counts.
    """
    numeric, categorical = numeric_columns(df), list(frequencies)
    exprs = [F.count(F.lit(1)).cast("long").alias("__rows")]
    for c in numeric:
        x = F.col(c).cast("double")
        exprs += [
            F.count(x).cast("long").alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
            F.sum(x).alias(f"{c}__sum"),
        ]
    wide = df.agg(*exprs)
    null_d = F.lit(None).cast("double")
    # the row count and every numeric column's stats come from the ONE wide aggregate row
    structs = [
        F.struct(F.lit("*").alias("column"), F.lit("rows").alias("kind"), F.col("__rows").alias("count"),
                 null_d.alias("mean"), null_d.alias("std"), null_d.alias("min"), null_d.alias("max"), null_d.alias("sum"))
    ] + [
        F.struct(F.lit(c).alias("column"), F.lit("numeric").alias("kind"), F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"), F.col(f"{c}__sum").alias("sum"))
        for c in numeric
    ]
    parts = [
        wide.select(F.explode(F.array(*structs)).alias("p")).select(
            "p.column", "p.kind", F.lit(None).cast("string").alias("value"), "p.count", "p.mean", "p.std", "p.min", "p.max", "p.sum")
    ]
    if categorical:
        # every categorical column in ONE scan: explode (column, value) pairs; map-side partial
        # counts keep the shuffle at (distinct values per task) rows
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                              for c in categorical])).alias("p")).select("p.column", "p.value")
        parts.append(
            pairs.groupBy("column", "value").agg(F.count(F.lit(1)).cast("long").alias("count")).select(
                "column", F.lit("frequency").alias("kind"), "value", "count",
                null_d.alias("mean"), null_d.alias("std"), null_d.alias("min"), null_d.alias("max"), null_d.alias("sum"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_profile(df: DataFrame, frequencies: Sequence[str], name: str = "profile", path: str | None = None) -> str:
    """Write the profile table (parquet) and return its path."""
    path = path or scratch_path(df.sparkSession, name)
    profile(df, frequencies).write.mode("overwrite").parquet(path)
    return path


def count_from_profile(spark, path: str) -> DataFrame:
    """Approximate COUNT(*) = the stored total, ci 0."""
    p = spark.read.parquet(path)
    return p.where(F.col("kind") == "rows").select(F.col("count").alias("count"), F.lit(True).alias("approx"), F.lit(0.0).alias("ci"))


def hll_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass: an HLL sketch per column in one wide row, unpivoted to (column, sketch)."""
    wide = df.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), HLL_LG_K).alias(c) for c in columns])
    structs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in columns]
    return wide.select(F.explode(F.array(*structs)).alias("s")).select("s.column", "s.sketch")


def build_sketches(df: DataFrame, key: str | Sequence[str], distinct: Sequence[str] = (), counts: Sequence[str] = (), strata: Sequence[str] = (),
                   name: str = "sketches", sample_size: int = 10000, seed: int = 42, share: float = 0.01) -> dict[str, str]:
    """Write synopses of ``df`` and return their paths.

    hll         an HLL sketch per column of ``distinct``
    cms         a Count-Min table per column of ``counts``
    heavy       a frequent-items summary per column of ``counts``: every value of more than ``share`` of the rows is in it
    sample      a bottom-k sample of ``sample_size`` rows with its pop_n and take_n
    stratified  per column of ``strata`` and value of it a bottom-k of ``sample_size`` rows, with the
                stratum's pop_n and take_n: (strata_column, strata_value, the columns of df...). A near-unique column
                has as many rows as the table, so the caller names the columns.
    Each kind is one pass for all its columns (samples: two), over the columns that it needs (samples store the whole
    rows). All merge with those of another part: see :func:`merge_sketches`.
    """
    spark = df.sparkSession
    base = scratch_path(spark, name)
    paths = {"sample": f"{base}/sample"}
    sample, n, N = samplers.sized_random(df, lambda total: min(total, sample_size), key, seed)
    sample.drop("sampling_weight").withColumns({"pop_n": F.lit(N).cast("long"), "take_n": F.lit(n).cast("long")}).write.parquet(paths["sample"])
    if distinct:
        paths["hll"] = f"{base}/hll"
        hll_columns(df, distinct).write.parquet(paths["hll"])
    if counts:
        paths["cms"] = f"{base}/cms"
        pairs = _pairs(df.select(*counts), counts).select(F.col("strata_column").alias("column"), "strata_value")
        cms_build(pairs, "strata_value", by="column").write.parquet(paths["cms"])
        paths["heavy"] = f"{base}/heavy"
        pairs.groupBy("column").agg(heavy_sketch("strata_value", share).alias("sketch")).write.parquet(paths["heavy"])
    if strata:
        paths["stratified"] = f"{base}/stratified"
        pairs, by = _pairs(df, strata), ["strata_column", "strata_value"]
        hist = samplers.histogram(pairs, by, key, seed)
        plan = samplers.sizes_of(hist, by).withColumn("take_n", F.least("pop_n", F.lit(sample_size)).cast("long"))
        samplers.from_plan(pairs, plan, by, key, seed, hist).drop("sampling_weight").write.partitionBy("strata_column").parquet(paths["stratified"])
    return paths


def _pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row once per column, with the column's name and value (as text)."""
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    return df.select("*", pair.alias("_pair")).select("*", F.col("_pair.c").alias("strata_column"), F.col("_pair.v").alias("strata_value")).drop("_pair")


def distinct_from_sketch(spark, path: str, column: str, alias: str = "approx_distinct") -> DataFrame:
    """COUNT(DISTINCT column) from the stored HLL synopsis."""
    return spark.read.parquet(path).where(F.col("column") == column).select(F.hll_sketch_estimate("sketch").alias(alias))


def counts_from_sketch(spark, path: str, column: str, keys: DataFrame, alias: str = "count") -> DataFrame:
    """COUNT(*) per key (a one-column frame of keys) from the stored Count-Min synopsis."""
    return cms_estimate(keys, keys.columns[0], spark.read.parquet(path).where(F.col("column") == column), alias=alias)


def heavy_counts(spark, paths: dict[str, str], column: str, share: float = 0.01) -> DataFrame:
    """D8 without the base table: (key, count) of the values of ``column`` (as text) that the frequent-items summary names,
    each counted by the Count-Min cells. Every value of more than ``share`` of the rows (as built) is among them."""
    summary = spark.read.parquet(paths["heavy"]).where(F.col("column") == column)
    return counts_from_sketch(spark, paths["cms"], column, heavy_keys(summary, "sketch", share))


def merge_profiles(spark, *paths: str, name: str = "profile") -> str:
    """D19 of the union of disjoint parts from the parts' profiles: counts and sums add up, deviations are merged by
    their means, so that no base table is read. Parts must have been profiled alike."""
    p = spark.read.parquet(*paths)
    n = F.col("count").cast("double")
    d = F.col("mean") - F.col("_all")
    # the union's mean per column first: the deviations are taken about it
    means = p.where(F.col("kind") == "numeric").groupBy("column").agg((F.sum(F.when(n > 0, F.col("mean") * n)) / F.sum(n)).alias("_all"))
    dev = F.coalesce(F.col("std") * F.col("std") * (n - 1), F.lit(0.0)) + F.when(n > 0, n * d * d).otherwise(0.0)
    total = F.sum("count").cast("long")
    merged = p.join(means, "column", "left").groupBy("column", "kind", "value").agg(
        total.alias("count"), F.max("_all").alias("_mean"), F.sum(dev).alias("_dev"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"))
    numeric = F.col("kind") == "numeric"
    out = merged.select("column", "kind", "value", "count", F.when(numeric, F.col("_mean")).alias("mean"), F.when(numeric & (F.col("count") > 1), F.sqrt(F.col("_dev") / (F.col("count") - 1))).alias("std"), "min", "max", "sum")
    path = scratch_path(spark, name)
    out.write.parquet(path)
    return path


def merge_sketches(spark, *parts: dict[str, str], key: str | Sequence[str], sample_size: int = 10000, seed: int = 42, share: float = 0.01,
                   name: str = "sketches") -> dict[str, str]:
    """D20 of the union of disjoint parts from the parts' synopses, without their tables: what ``build_sketches`` would
    have written over all (HLL and frequent-items summaries: the union's). ``key``, ``sample_size``, ``seed`` and
    ``share`` are those that all parts were built with."""
    base = scratch_path(spark, name)
    kinds = [k for k in ("sample", "hll", "cms", "heavy", "stratified") if all(k in p for p in parts)]
    paths = {k: f"{base}/{k}" for k in kinds}
    read = lambda k: spark.read.parquet(*[p[k] for p in parts]) if k != "stratified" else reduce(DataFrame.unionByName, [spark.read.parquet(p[k]) for p in parts])
    merged = {
        "sample": lambda r: _merge_samples(r.withColumn("_all", F.lit(1)), ["_all"], key, sample_size, seed).drop("_all"),
        "hll": lambda r: r.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch")),
        "cms": lambda r: cms_merge(r, by="column"),
        "heavy": lambda r: r.groupBy("column").agg(heavy_merge("sketch", share).alias("sketch")),
        "stratified": lambda r: _merge_samples(r, ["strata_column", "strata_value"], key, sample_size, seed),
    }
    for k in kinds:
        writer = merged[k](read(k)).write
        (writer.partitionBy("strata_column") if k == "stratified" else writer).parquet(paths[k])
    return paths


def _merge_samples(rows: DataFrame, by: Sequence[str], key: str | Sequence[str], k: int, seed: int) -> DataFrame:
    """Bottom-k samples of disjoint parts to that of their union, per stratum. A part's rows tell its stratum's size: pop_n
    over take_n for each of take_n rows."""
    sizes = rows.groupBy(*by).agg(F.round(F.sum(F.col("pop_n") / F.col("take_n"))).cast("long").alias("pop_n"))
    plan, _ = store(sizes.withColumn("take_n", F.least("pop_n", F.lit(k)).cast("long")), "sizes")
    return samplers.from_plan(rows.drop("pop_n", "take_n"), plan, by, key, seed).drop("sampling_weight")


def build_stratified_sample(df: DataFrame, by: str | Sequence[str], key: str | Sequence[str], accuracy: float = 95, seed: int = 42,
                            name: str = "stratified_sample", path: str | None = None, min_sample: int | None = None, max_sample: int | None = None) -> str:
    """Stratified sample synopsis for approximate GROUP BY on ``by``: the accuracy-sized sample
    (max(1, k N_h / N) rows per stratum) with its ``pop_n`` / ``take_n`` columns, written once;
    ``approximate.approx_agg_from_sample`` answers later queries from it without touching ``df``."""
    hist = samplers.histogram(df, by, key, seed)
    N = hist.agg(F.sum("_n")).first()[0] or 0
    plan = allocate(samplers.sizes_of(hist, by), size_for_accuracy(accuracy, N, min_sample, max_sample), by, "min_one", stored=True, total=N)
    path = path or scratch_path(df.sparkSession, name)
    samplers.from_plan(df, plan, by, key, seed, hist).write.mode("overwrite").parquet(path)
    return path


def strata_sizes_from_profile(spark, path: str, column: str, dtype: str = "string") -> DataFrame:
    """Stratum sizes (column, pop_n) from a profile synopsis' frequency rows, without a pass over the table:
    for ``plans.allocation.allocate`` and ``bounds.stratified_bounds``."""
    p = spark.read.parquet(path)
    return p.where((F.col("kind") == "frequency") & (F.col("column") == column)).select(
        F.col("value").cast(dtype).alias(column), F.col("count").alias("pop_n")
    )
