"""Run registered queries against their SQL twins in DuckDB and report mismatches.

usage: python tools/check.py [--sf DIR] [--only a,b] [--modules m1,m2]
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

from sparkwright.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from sparkwright.session import get_spark  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "is_finite"):
        return f"DEC{v}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [names[i] for i in order]


KIND = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "BOOLEAN": "boolean", "FLOAT": "float"}


def kind(t):
    t = str(t)
    if t.endswith("[]"):
        return f"array<{kind(t[:-2])}>"
    return KIND.get(t, t)


def compare(spark, con, name, sf, df=None):
    start = time.time()
    df = QUERIES[name](spark, sf) if df is None else df
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return f"rows-only {len(got)}", took, True
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    types = dict(zip(names, [kind(c[1]) for c in cur.description]))
    want, wn = rows_of(names, cur.fetchall())
    have, hn = rows_of(df.columns, got)
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if wn != hn:
        return f"COLUMNS {hn} != {wn}", took, False
    note = "" if mine == types else f" TYPES { {k: (mine[k], types[k]) for k in mine if mine[k] != types[k]} }"
    if want == have:
        return f"ok {len(have)}{note}", took, not note
    diff = [(h, w) for h, w in zip(have, want) if h != w][:2]
    return f"MISMATCH {len(have)} vs {len(want)} e.g. {str(diff)[:700]}{note}", took, False


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--only", default="")
    ap.add_argument("--modules", default="")
    args = ap.parse_args()
    if args.modules:
        for m in args.modules.split(","):
            importlib.import_module(f"sparkwright.plans.{m}")
    else:
        load_all()
    spark = get_spark("check", cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    only = [x for x in args.only.split(",") if x]
    bad = 0
    for name in only or list(QUERIES):
        try:
            message, took, fine = compare(spark, con, name, args.sf)
        except Exception as e:  # report and go on
            message, took, fine = f"ERROR {type(e).__name__}: {str(e)[:900]}", 0.0, False
        bad += not fine
        print(f"{'   ' if fine else '** '}{name:26s} {took:6.2f}s {message}", flush=True)
    print(f"{bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
