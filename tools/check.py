"""Run registered queries and compare them with their SQL in DuckDB.

usage: python tools/check.py [--sf 0.01] [--hot N] [--cpus 8] [name ...]
Names may be prefixes.
"""

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from relweave.queries import ORACLES, QUERIES
from relweave.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(int(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--hot")
    ap.add_argument("--cpus", default="8")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        "check", f"local[{args.cpus}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if args.hot:
        spark.conf.set("spark.relweave.hotRows", args.hot)
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = []
    total = 0.0
    for name, fn in QUERIES.items():
        if args.names and not any(name == n or name.startswith(n + "_") or (n.endswith("*") and name.startswith(n[:-1])) for n in args.names):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            got = df.collect()
            spent = time.time() - start
            total += spent
            status = "rows only"
            if name in ORACLES:
                cur = db.execute(ORACLES[name])
                cols = [d[0] for d in cur.description]
                want_types = {d[0]: str(d[1]) for d in cur.description}
                want = cur.fetchall()
                a, b = rows_of(df.columns, got), rows_of(cols, want)
                if a[0] != b[0]:
                    status = f"COLUMNS {a[0]} / {b[0]}"
                elif len(got) != len(want):
                    status = f"COUNT {len(got)} / {len(want)}"
                elif a[1] != b[1]:
                    diff = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
                    status = f"VALUES {len(diff)} differ {a[0]}, e.g. {diff[0]}"
                else:
                    status = "ok"
                    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
                    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
                    odd = {k: (types[k], want_types[k]) for k in types if types[k] in same and same[types[k]] != want_types[k]}
                    if odd:
                        status = f"ok, types differ {odd}"
            if not got:
                status += " EMPTY"
        except Exception as exc:  # report and go on
            status = f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
            spent = time.time() - start
        if not status.startswith(("ok", "rows only")) or "EMPTY" in status:
            bad.append(name)
        print(f"{name:42s} {spent:6.2f}s  {status}", flush=True)
    print(f"{len(bad)} bad: {bad}; {total:.1f}s")


if __name__ == "__main__":
    main()
