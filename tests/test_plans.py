"""Physical-plan shape: pushdown, pruning, bounded top-k, broadcast of checked small sides."""

from pyspark.sql import functions as F

from approxspark.operators import samplers
from approxspark.sources.tables import sales, table
from conftest import SF_CHECK


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_reach_the_scan(spark):
    ev = table(spark, SF_CHECK, "events")
    q = ev.where((F.col("event_type") == "purchase") & (F.col("value") > 100)).agg(F.sum("value"))
    p = _plan(q)
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,purchase)" in p
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_samples_are_not_sorted_in_one_task(spark):
    li = table(spark, SF_CHECK, "lineitem")
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    for smp in (samplers.simple_random(li, 20000, key, 1), samplers.weighted(li, 20000, key, "l_quantity", 1), samplers.stratified(li, 20000, "l_returnflag", key, 1)):
        p = _plan(smp)
        assert "SinglePartition" not in p and "TakeOrdered" not in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_bootstrap_reads_the_sample_once_and_joins_nothing(spark):
    from approxspark.operators import bounds

    ev = table(spark, SF_CHECK, "events")
    for stat in (F.avg, F.median):
        p = _plan(bounds.bootstrap_bounds(ev, "value", "event_id", 40, estimator=stat, by="event_type"))
        assert "Join" not in p and "Window" not in p and "SinglePartition" not in p


def test_sketch_is_not_built_per_value(spark):
    from approxspark.operators import sketches

    p = _plan(sketches.hll_estimate(table(spark, SF_CHECK, "events"), "user_id"))
    assert "keys=[user_id" not in p
    assert _plan(sketches.cms_build(table(spark, SF_CHECK, "events"), "user_id")).count("Exchange hashpartitioning") == 1


def test_sales_view_prunes_columns(spark):
    p = _plan(sales(spark, SF_CHECK).select("category"))
    schemas = [part.split("]")[0] for part in p.split("ReadSchema: ")[1:]]
    assert all("o_totalprice" not in sch and "o_orderdate" not in sch and "c_name" not in sch for sch in schemas)
    assert any("c_mktsegment" in sch for sch in schemas)


def _read(df):
    """Columns that the plan's scans read, taken from the scans themselves (their text is shortened)."""
    found = []

    def visit(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append({f.name() for f in node.requiredSchema().fields()})
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            visit(node.inputPlan())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_samplers_read_the_columns_in_use_only(spark):
    li = table(spark, SF_CHECK, "lineitem")
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    # (sampler, what it reads by itself)
    cases = [
        (samplers.simple_random(li, 300, key, 3), set(key)),
        (samplers.sized(li, key, error_margin=0.05), set(key)),
        (samplers.stratified(li, 300, "l_returnflag", key, 3), {*key, "l_returnflag"}),
        (samplers.stratified(li, 300, "l_returnflag", key, 3, "neyman", "l_extendedprice"), {*key, "l_returnflag"}),
        (samplers.weighted(li, 300, key, "l_tax", 3), {*key, "l_tax"}),
        (samplers.reservoir(li, 300, key, 3), set(key)),
        (samplers.reservoir(li, 300, key, 3, strata="l_returnflag"), {*key, "l_returnflag"}),
        (samplers.systematic(li, 300, "l_orderkey", 3, key=key), set(key)),
        (samplers.cluster(li, 30, "l_suppkey", 3), {"l_suppkey"}),
    ]
    for smp, own in cases:
        scans = _read(smp.select("l_orderkey", "l_quantity"))
        assert any(s & {"l_quantity"} for s in scans)
        of_table = {c for c in set().union(*scans) if c in li.columns}
        assert of_table <= own | {"l_orderkey", "l_quantity"}, (smp.columns, of_table)


def test_named_ties_make_repeated_keys_independent_of_the_partitioning(spark):
    rows = spark.range(3000).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    for draw in (lambda d: samplers.simple_random(d, 500, "k", 1, tie=["k", "v"]), lambda d: samplers.stratified(d.withColumn("h", F.col("v") % 3), 500, "h", "k", 1, tie="v")):
        a, b = (sorted(r["v"] for r in draw(rows.repartition(n, F.rand(n))).collect()) for n in (2, 9))
        assert a == b and len(a) == 500
