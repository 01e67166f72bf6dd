"""Local correctness check: every registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: row count, column names (sorted) and an order-insensitive hash of the
values. Usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from approxspark.catalog import ORACLES, QUERIES, load_all  # noqa: E402
from approxspark.session import build_session  # noqa: E402
from approxspark.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        if v == int(v) and abs(v) < 1e15:
            return repr(float(v))
        return repr(v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name in names or sorted(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR spark {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in ORACLES:
            print(f"rows-only {name}: {len(srows)} rows {dt:.1f}s")
            continue
        try:
            rel = con.execute(ORACLES[name])
            dcols = [c[0] for c in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR duckdb {name}: {str(e)[:400]}")
            bad += 1
            continue
        def kinds(cols, rows):
            out = {}
            for i, c in enumerate(cols):
                ts = {type(r[i].item() if hasattr(r[i], "item") else r[i]).__name__ for r in rows if r[i] is not None}
                out[c] = ",".join(sorted(ts))
            return out

        sk, dk = kinds(scols, srows), kinds(dcols, drows)
        type_diff = {c: (sk[c], dk.get(c)) for c in sk if dk.get(c) is not None and sk[c] != dk[c] and sk[c] and dk[c]}
        if type_diff:
            print(f"TYPES {name}: {type_diff}")
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        if sorted(scols) != sorted(dcols) or sh != dh:
            bad += 1
            print(f"MISMATCH {name}: cols spark={sorted(scols)} duck={sorted(dcols)} rows {len(srows)} vs {len(drows)}")
            diff_s = [x for x in sl if x not in set(dl)][:3]
            diff_d = [x for x in dl if x not in set(sl)][:3]
            print("   spark-only:", diff_s)
            print("   duck-only: ", diff_d)
        else:
            ok += 1
            print(f"ok {name}: {len(srows)} rows {dt:.1f}s")
    print(f"== {ok} ok, {bad} bad, {len(QUERIES) - len(ORACLES)} rows-only")
    spark.stop()


if __name__ == "__main__":
    main()
