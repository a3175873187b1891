"""Local parity check: run registered queries in Spark and their SQL in DuckDB.

    python -m scoria.plans.check /root/testdata/sf0.01 [name ...]

Compares row counts, column names and the multiset of rows (floats
rounded).  This mirrors the driver's correctness gate.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is getattr(__import__("pandas"), "NA"):
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        v = v.item()
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip("0: ") == "" else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return dict(name=name, rows=len(sp), oracle=None, ok=None, sec=round(t1 - t0, 2))
    du = con.execute(sql).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(du)
    ok = c1 == c2 and r1 == r2
    info = dict(name=name, rows=len(sp), oracle_rows=len(du), ok=ok, sec=round(t1 - t0, 2))
    if not ok:
        if c1 != c2:
            info["cols"] = (c1, c2)
        else:
            d1 = [r for r in r1 if r not in set(r2)][:3]
            d2 = [r for r in r2 if r not in set(r1)][:3]
            info["diff"] = (d1, d2)
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from scoria.plans.catalog import ORACLES, QUERIES
    from scoria.session import get_spark
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, name, fn, ORACLES.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            info = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:400]}")
        bad += info.get("ok") is False
        print(info, flush=True)
    print(f"failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
