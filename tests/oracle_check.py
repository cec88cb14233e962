"""Spark query vs DuckDB oracle: row count, column names, order-free values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from threadlens.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (np.floating,)):
        return None if np.isnan(v) else round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_, bool)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    if v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v if isinstance(v, (str, int)) else str(v)


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df[cols].to_dict("records")]
    rows.sort(key=repr)
    return cols, rows


def oracle_con(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name, sf_dir, con, verbose=True):
    from threadlens.plans import ORACLES, QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir).toPandas()
    t1 = time.time()
    if name not in ORACLES:
        print(f"{name:22s} rows={len(sdf):7d} (no oracle) spark={t1-t0:.1f}s")
        return None
    odf = con.sql(ORACLES[name]).df()
    sc, sr = canon(sdf)
    oc, orows = canon(odf)
    ok = sc == oc and len(sr) == len(orows) and sr == orows
    print(f"{name:22s} {'OK ' if ok else 'BAD'} rows={len(sr)}/{len(orows)} spark={t1-t0:.1f}s")
    if not ok and verbose:
        if sc != oc:
            print("   cols", sc, oc)
        else:
            a, b = set(sr), set(orows)
            print("   only spark:", list(a - b)[:3])
            print("   only oracle:", list(b - a)[:3])
    return ok


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not a.startswith("/")]
    from threadlens.plans import QUERIES, load_all
    from threadlens.session import local_session
    load_all()
    spark = local_session()
    con = oracle_con(sf)
    bad = []
    for n in names or list(QUERIES):
        try:
            if compare(spark, n, sf, con) is False:
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"{n:22s} ERROR {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("BAD:", bad)


if __name__ == "__main__":
    main()
