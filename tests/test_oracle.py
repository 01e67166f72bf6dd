"""Every registered query against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import hashlib
import math

import duckdb
import pytest

from approxspark.catalog import ORACLES, QUERIES, load_all
from approxspark.sources.tables import TABLES
from conftest import SF_SMALL

load_all()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        v = float(v)
        if math.isnan(v):
            return "NaN"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return repr(v)
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows is not None
        return
    rel = con.execute(ORACLES[name])
    dcols = [c[0] for c in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)
