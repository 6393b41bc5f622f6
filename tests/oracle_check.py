"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema, exact value match, tolerant match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) for v in row)


def compare(spark_pdf, duck_pdf, tol=1e-6):
    scols, dcols = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if scols != dcols:
        return False, False, f"columns differ: spark-only {set(scols) - set(dcols)} oracle-only {set(dcols) - set(scols)}"
    a = [tuple(None if (x is None or (isinstance(x, float) and math.isnan(x) and False)) else x for x in r)
         for r in spark_pdf[scols].itertuples(index=False, name=None)]
    b = [tuple(r) for r in duck_pdf[scols].itertuples(index=False, name=None)]
    a = [tuple(None if _isnull(x) else x for x in r) for r in a]
    b = [tuple(None if _isnull(x) else x for x in r) for r in b]
    if len(a) != len(b):
        return False, False, f"rows {len(a)} vs {len(b)}"
    exact = sorted(map(repr, [tuple(_norm(x) for x in r) for r in a])) == sorted(
        map(repr, [tuple(_norm(x) for x in r) for r in b]))
    sa, sb = sorted(a, key=_key), sorted(b, key=_key)
    bad = 0
    first = None
    for ra, rb in zip(sa, sb):
        for c, x, y in zip(scols, ra, rb):
            if not _close(x, y, tol):
                bad += 1
                if first is None:
                    first = (c, x, y)
                break
    return exact, bad == 0, (f"{bad} rows differ, first {first}" if bad else "ok")


def _isnull(x):
    try:
        import pandas as pd

        return x is None or (not isinstance(x, (list, tuple, dict)) and pd.isna(x))
    except (TypeError, ValueError):
        return False


def _close(x, y, tol):
    if x is None or y is None:
        return x is None and y is None
    if isinstance(x, float) or isinstance(y, float):
        try:
            return abs(float(x) - float(y)) <= tol * max(1.0, abs(float(y)))
        except (TypeError, ValueError):
            return False
    if hasattr(x, "item"):
        x = x.item()
    if hasattr(y, "item"):
        y = y.item()
    return str(x) == str(y)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as entry
    from rateweave.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in (names or sorted(qs)):
        t = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
            st = time.time() - t
        except Exception as ex:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {type(ex).__name__}: {str(ex)[:400]}")
            failed += 1
            continue
        if name not in os_:
            print(f"{name}: rows={len(spdf)} (no oracle) spark {st:.1f}s")
            continue
        try:
            dpdf = con.sql(os_[name]).df()
        except Exception as ex:  # noqa: BLE001
            print(f"{name}: ORACLE ERROR {type(ex).__name__}: {str(ex)[:400]}")
            failed += 1
            continue
        exact, ok, msg = compare(spdf, dpdf)
        types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        print(f"{name}: rows={len(spdf)}/{len(dpdf)} exact={exact} tol={ok} {msg} spark {st:.1f}s "
              f"types={types if not ok else ''}")
        failed += 0 if ok else 1
    print("FAILED", failed)


if __name__ == "__main__":
    main()
