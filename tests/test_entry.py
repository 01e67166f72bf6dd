"""Driver contract: entry() is stable, queries() and oracle_sql() line up."""

import importlib.util
import os

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_is_stable(spark):
    m = _entry_module()
    a, b = m.entry(spark), m.entry(spark)
    assert a.schema == b.schema
    ra, rb = sorted(tuple(r) for r in a.collect()), sorted(tuple(r) for r in b.collect())
    assert ra == rb and len(ra) > 0


def test_every_query_has_an_oracle():
    m = _entry_module()
    from approxspark.catalog import ORACLES, QUERIES

    m.queries()
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(m.queries()) and set(ORACLES) <= set(m.oracle_sql())
