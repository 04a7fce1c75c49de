"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tools/oracle_check.py [--sf 0.01] [--time] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted((tuple(norm(r[k]) for k in order) for r in rows), key=repr)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--module", default=None)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    sf = f"/root/testdata/sf{a.sf}"
    from pelagia.session import get_spark
    spark = get_spark("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
                      spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    if a.module:
        for m in a.module.split(","):
            importlib.import_module(f"pelagia.queries.{m}")
        from pelagia.queries.registry import REGISTRY as reg
    else:
        from pelagia.queries import load
        reg = load()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    print = __import__('functools').partial(__builtins__.print, flush=True)
    for name, q in reg.items():
        if a.names and not any(name.startswith(p) for p in a.names):
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf)
            cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: spark: {str(e)[:700]}")
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"rows {name}: {len(got)} rows {t1 - t0:.1f}s (no SQL)")
            continue
        try:
            cur = con.execute(q.sql)
            ocols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: sql: {str(e)[:700]}")
            continue
        t2 = time.time()
        if cols != ocols:
            bad += 1
            print(f"FAIL {name}: columns {cols} vs {ocols}")
        elif got != want:
            bad += 1
            sg, sw = set(got), set(want)
            print(f"DIFF {name}: spark {len(got)} sql {len(want)}; only spark {len(sg - sw)} only sql {len(sw - sg)}; {t1 - t0:.1f}s {t2 - t1:.1f}s cols {cols}")
            for x, y in list(zip(sorted(sg - sw, key=repr), sorted(sw - sg, key=repr)))[:3]:
                print("   spark", x)
                print("   sql  ", y)
        else:
            print(f"ok   {name}: {len(got)} rows spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s")
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
