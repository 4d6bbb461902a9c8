"""Compare registered queries with their SQL in DuckDB.

    python check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

from tallyward.queries import registry
from tallyward.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, bool) or isinstance(value, (int, str)):
        return value
    return str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def main() -> int:
    registry.load_all()
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.QUERIES)
    spark = local_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = registry.QUERIES[name](spark, folder)
            columns, types = df.columns, dict(df.dtypes)
            rows = df.collect()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {str(e)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in registry.ORACLES:
            print(f"rows  {name}: {len(rows)} rows {took:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(registry.ORACLES[name])
            their_columns = [d[0] for d in cur.description]
            their_types = {d[0]: str(d[1]) for d in cur.description}
            theirs = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"SQLERR {name}: {str(e)[:1200]}", flush=True)
            continue
        (c1, b1), (c2, b2) = bag(columns, rows), bag(their_columns, theirs)
        if c1 == c2 and b1 == b2:
            print(f"ok    {name}: {len(rows)} rows {took:.1f}s", flush=True)
            continue
        bad += 1
        print(f"DIFF  {name}: rows {len(rows)} vs {len(theirs)}; columns {c1 == c2}", flush=True)
        if c1 != c2:
            print("   ", c1, "\n   ", c2)
        else:
            print("    spark ", list((b1 - b2).items())[:3], "\n    duckdb", list((b2 - b1).items())[:3])
            print("    types ", types, their_types)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
