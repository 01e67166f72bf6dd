"""Result sinks (A3, A4): write a result, read it back with its schema."""

from __future__ import annotations

from ..operators import exact
from ..session import scratch_path
from ..sources import sinks
from ..sources.tables import SALES_SQL, sales
from . import register, rounded

STATS_SQL = (
    f"SELECT category, count(*)::BIGINT AS count, round(avg(price), 4) AS avg_price, round(sum(price), 2) AS sum_price "
    f"FROM {SALES_SQL} GROUP BY category"
)


def _stats(spark, d):
    res = exact.exact_agg(sales(spark, d), [("count", None, None), ("avg", "price", None), ("sum", "price", None)], by="category")
    return rounded(res, sum_price=2, avg_price=4)


@register("sink_csv_roundtrip", STATS_SQL)
def sink_csv_roundtrip(spark, d):
    res = _stats(spark, d)
    path = sinks.write_csv(res, scratch_path(spark, "csv-sink"))
    return sinks.read_csv(spark, path, res.schema)


@register("sink_json_roundtrip", STATS_SQL)
def sink_json_roundtrip(spark, d):
    res = _stats(spark, d)
    path = sinks.write_json(res, scratch_path(spark, "json-sink"))
    return sinks.read_json(spark, path, res.schema)
