"""Run registered queries next to their SQL in DuckDB and compare the results value by value.

usage: python tools/compare.py [--dir DIR] [--module queries_x] [name ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ebbtide.plans import registry  # noqa: E402
from ebbtide.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if x is None:
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        if math.isnan(x):
            return "null"
        return repr(0.0 if x == 0 else x)
    if hasattr(x, "item"):
        return cell(x.item())
    return str(x)


def lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted("|".join(cell(r[i]) for i in order) for r in rows)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--dir", default="/root/testdata/sf0.01")
    ap.add_argument("--module", default="catalog")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    importlib.import_module(f"ebbtide.plans.{a.module}")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{a.dir}/{t}.parquet'")
    spark = local_session()
    bad = []
    own = [n for n, f in registry.QUERIES.items() if a.module == "catalog" or f.defined_in.endswith(a.module)]
    for name in a.names or own:
        t0 = time.time()
        try:
            df = registry.QUERIES[name](spark, a.dir)
            rows = df.collect()
            took = time.time() - t0
            if name not in registry.ORACLE:
                print(f"rows  {name:28s} {took:6.1f}s {len(rows)}", flush=True)
                continue
            rel = con.execute(registry.ORACLE[name])
            dcols = [c[0] for c in rel.description]
            got, want = lines(df.columns, rows), lines(dcols, rel.fetchall())
            if got == want:
                print(f"ok    {name:28s} {took:6.1f}s {len(rows)}", flush=True)
            else:
                bad.append(name)
                print(f"DIFF  {name:28s} {took:6.1f}s spark={len(rows)} sql={len(want[1])}", flush=True)
                if got[0] != want[0]:
                    print("   columns", got[0], want[0])
                g, w = set(got[1]), set(want[1])
                print("   only spark", sorted(g - w)[:3])
                print("   only sql  ", sorted(w - g)[:3], flush=True)
        except Exception as e:
            bad.append(name)
            print(f"FAIL  {name:28s} {str(e)[:700]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("bad:", bad)


if __name__ == "__main__":
    main()
