"""Run queries and their SQL twins side by side: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from pathlark.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((x is None, str(type(x)), x) for x in r),
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    spark = build_session("compare", f"local[{os.environ.get('BENCH_CPUS', '8')}]", 8, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = rows_of(df.columns, df.collect())
            took = time.time() - start
            if name not in ORACLE:
                print(f"rows  {name} {len(got)} {took:.1f}s", flush=True)
                bad += not got
                continue
            rel = con.sql(ORACLE[name])
            want = rows_of(rel.columns, rel.fetchall())
        except Exception as e:
            print(f"ERROR {name}: {str(e)[:600]}", flush=True)
            bad += 1
            continue
        same = sorted(df.columns) == sorted(rel.columns) and got == want
        print(f"{'ok   ' if same else 'DIFF '} {name} {len(got)}/{len(want)} {took:.1f}s", flush=True)
        if not same:
            bad += 1
            print("  columns", sorted(df.columns), sorted(rel.columns))
            a, b = set(got) - set(want), set(want) - set(got)
            print("  only spark", len(a), sorted(a, key=str)[:3])
            print("  only sql  ", len(b), sorted(b, key=str)[:3], flush=True)
    print(f"{len(names)} queries, {bad} not matching")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
