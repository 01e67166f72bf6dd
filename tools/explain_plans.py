"""Print the physical plans behind PLANS.md (one per operator family) for a scale-factor folder.

Usage: python tools/explain_plans.py [sf_dir]
Samplers count a histogram first; what is shown is their second pass.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from approxspark.operators import exact, samplers, sketches, synopsis  # noqa: E402
from approxspark.session import build_session  # noqa: E402
from approxspark.sources.tables import sales, table  # noqa: E402


def show(title: str, df) -> None:
    print(f"\n===== {title}")
    print(df._jdf.queryExecution().executedPlan().toString())


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    s = sales(spark, d)
    ev = table(spark, d, "events")
    li = table(spark, d, "lineitem")
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]

    show("exact GROUP BY with COUNT DISTINCT",
         exact.exact_agg(s, [("count", None, None), ("sum", "price", None), ("count_distinct", "user_id", None)], by="category"))

    show("stratified sample, second pass", samplers.stratified(s, 1000, "category", "id", 42, "min_one").select("id", "category"))
    show("simple random, second pass", samplers.simple_random(li, 1000, key, 42).select(*key))
    show("Count-Min build", sketches.cms_build(ev, "user_id"))
    show("HLL per group", sketches.hll_estimate(ev, "user_id", "event_type"))
    show("profile synopsis (one scan)", synopsis.profile(ev, ["event_type"]))
    spark.stop()


if __name__ == "__main__":
    main()
