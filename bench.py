"""Benchmark: the reference's six headline queries (exact and approximate) plus the heavier
operators, on $BENCH_SF_DIR (default /root/testdata/sf0.1) with local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Each timing covers building the plan, any eager sizing passes inside the operator and the
final collect. Every query runs twice: the first (cold) run pays JVM JIT and whole-stage codegen
compilation and is reported separately as ``cold_queries`` / ``cold_value``; the timed value is the
best of two further (warm) runs, which damps noise on a shared machine. The cache is cleared
before each run, so no persisted sample from a previous run is reused.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from approxspark.catalog import QUERIES, load_all  # noqa: E402
from approxspark.catalog.approximate_q import FLAGSHIP_AGGS, REFERENCE_LIMITS  # noqa: E402
from approxspark.operators import approximate, sketches, synopsis  # noqa: E402
from approxspark.session import build_session  # noqa: E402
from approxspark.sources.tables import sales  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    load_all()
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, CPUS * 2), app="approxspark-bench")
    d = SF_DIR
    s = lambda: sales(spark, d)

    profile_path: dict[str, str] = {}

    sample_path: dict[str, str] = {}

    def build_sample():
        sample_path["p"] = synopsis.build_stratified_sample(s(), "category", "id", 95, 42, "bench-sample", **REFERENCE_LIMITS)
        return spark.read.parquet(sample_path["p"]).limit(1)

    def from_sample(aggs):
        return approximate.approx_agg_from_sample(spark.read.parquet(sample_path["p"]), aggs, "category")

    sketch_paths: dict[str, str] = {}

    def build_sketches():
        sketch_paths.update(synopsis.build_sketches(s(), "id", ["user_id"], ["category"], sample_size=1000, name="bench-sketches"))
        return spark.read.parquet(sketch_paths["hll"]).limit(1)

    def build_profile():
        profile_path["p"] = synopsis.build_profile(s(), ["category"], "bench-profile")
        return spark.read.parquet(profile_path["p"])

    cases = {
        # the reference's query set (run_demo.py), exact
        "count_exact": lambda: QUERIES["exact_count"](spark, d),
        "distinct_exact": lambda: QUERIES["exact_count_distinct"](spark, d),
        "sum_exact": lambda: QUERIES["exact_sum"](spark, d),
        "avg_exact": lambda: QUERIES["exact_avg"](spark, d),
        "group_by_exact": lambda: QUERIES["group_by_count"](spark, d),
        "complex_exact": lambda: QUERIES["category_stats"](spark, d),
        # approximate: synopsis built once, then answered from it / sketches / samples
        "synopsis_build": build_profile,
        "count_approx": lambda: synopsis.count_from_profile(spark, profile_path["p"]),
        "distinct_approx": lambda: sketches.hll_estimate(s(), "user_id"),
        "sum_approx": lambda: approximate.approx_agg(s(), [("sum", "price", "sum_price")], key="id", **REFERENCE_LIMITS),
        "avg_approx": lambda: approximate.approx_agg(s(), [("avg", "price", "avg_price")], key="id", **REFERENCE_LIMITS),
        "group_by_approx": lambda: QUERIES["approx_group_by"](spark, d),
        "complex_approx": lambda: QUERIES["flagship_approx_agg"](spark, d),
        # the same aggregates answered from stored synopses (built once, as the reference's cache)
        "sketch_synopsis_build": build_sketches,
        "distinct_from_synopsis": lambda: synopsis.distinct_from_sketch(spark, sketch_paths["hll"], "user_id"),
        "sum_from_synopsis": lambda: approximate.approx_agg_from_sample(spark.read.parquet(sketch_paths["sample"]), [("sum", "price", "sum_price")]),
        "avg_from_synopsis": lambda: approximate.approx_agg_from_sample(spark.read.parquet(sketch_paths["sample"]), [("avg", "price", "avg_price")]),
        # GROUP BY answered from the stratified-sample synopsis (built once, as the reference's cache)
        "sample_synopsis_build": build_sample,
        "group_by_from_synopsis": lambda: from_sample([("count", None, "count")]),
        "complex_from_synopsis": lambda: from_sample(FLAGSHIP_AGGS),
        # heavier operators
        "stratified_neyman": lambda: QUERIES["sample_stratified_neyman"](spark, d),
        "systematic": lambda: QUERIES["sample_systematic"](spark, d),
        "weighted": lambda: QUERIES["sample_weighted"](spark, d),
        "bootstrap": lambda: QUERIES["bounds_bootstrap"](spark, d),
        "bounds_stratified": lambda: QUERIES["bounds_stratified"](spark, d),
        "cms_point_estimate": lambda: QUERIES["cms_point_estimate"](spark, d),
        "ci_coverage": lambda: QUERIES["ci_coverage"](spark, d),
        "stream_group_agg": lambda: QUERIES["stream_group_agg"](spark, d),
    }
    # warm-up (JIT, file listing cache) outside the timings
    spark.read.parquet(f"{d}/orders.parquet").agg(F.count(F.lit(1))).collect()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, fn in cases.items():
        runs = []
        for _ in range(3):
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            fn().collect()
            runs.append(round(time.perf_counter() - t0, 4))
        cold[name], times[name] = runs[0], min(runs[1:])
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 4), "unit": "sec",
                      "queries": times, "sf": _sf(d), "cold_value": round(sum(cold.values()), 4), "cold_queries": cold}))


if __name__ == "__main__":
    main()
