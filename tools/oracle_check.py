"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]

Row count, column names and an order-insensitive comparison of values
(doubles to 9 significant digits) are reported per key.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


TYPE_MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
            "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "HUGEINT": "hugeint"}


def norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.{digits}g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.{digits}g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist(), digits)
    if isinstance(v, bool):
        return v
    return v


def rows_of(records, cols, digits):
    return Counter(tuple(norm(r[c], digits) for c in cols) for r in records)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--digits", type=int, default=9)
    ap.add_argument("--types", action="store_true", help="also report column type differences")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()

    import duckdb
    from postlens.plans import catalog
    from postlens.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=8)
    qs = catalog.queries()
    oracles = catalog.oracle_sql()
    keys = args.keys or list(qs)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            sdf = qs[k](spark, args.sf)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as exc:  # noqa: BLE001
            print(f"{k:32s} SPARK-ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in oracles:
            print(f"{k:32s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(oracles[k])
            ocols = [d[0] for d in cur.description]
            orows = [dict(zip(ocols, r)) for r in cur.fetchall()]
        except Exception as exc:  # noqa: BLE001
            print(f"{k:32s} ORACLE-ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        if sorted(scols) != sorted(ocols):
            print(f"{k:32s} COLUMNS spark={sorted(scols)} oracle={sorted(ocols)}")
            bad += 1
            continue
        cols = sorted(scols)
        if args.types:
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            otypes = {d[0]: str(d[1]) for d in cur.description}
            diff = {c: (stypes[c], otypes[c]) for c in cols
                    if TYPE_MAP.get(otypes[c], otypes[c].lower()) != stypes[c]}
            if diff:
                print(f"{k:32s} TYPES {diff}")
        a, b = rows_of(srows, cols, args.digits), rows_of(orows, cols, args.digits)
        ok = a == b
        status = "OK" if ok else "MISMATCH"
        print(f"{k:32s} {status} rows spark={len(srows)} oracle={len(orows)} {ts:.1f}s")
        if not ok:
            bad += 1
            only_s = list((a - b).elements())[:3]
            only_o = list((b - a).elements())[:3]
            print("   cols:", cols)
            print("   spark-only:", only_s)
            print("   oracle-only:", only_o)
    print(f"done: {len(keys)} keys, {bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
