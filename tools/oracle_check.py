"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]

Compares row count, column names and an order-insensitive multiset of
rounded values, the way the driver's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans import registry  # noqa: E402
from quarry.session import local_session  # noqa: E402
from quarry.sources.tables import TABLES  # noqa: E402


SPARK2DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
              "BooleanType": "BOOLEAN", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "FloatType": "FLOAT",
              "ShortType": "SMALLINT", "ByteType": "TINYINT", "ArrayType": "", "StructType": ""}


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 5)
        return 0.0 if r == 0 else r
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    registry.load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, fn in sorted(registry.QUERIES.items()):
        if pats and not any(p in name for p in pats):
            continue
        sql = registry.ORACLE.get(name)
        t0 = time.time()
        try:
            df = fn(spark, sf)
            s_names = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark error {e!r}"[:2000])
            traceback.print_exc(limit=3)
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ROWS {name}: {len(s_rows)} rows ({ts:.1f}s), no oracle")
            ok += 1
            continue
        try:
            cur = con.execute(sql)
            d_names = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: duckdb error {e!r}"[:2000])
            continue
        if sorted(s_names) != sorted(d_names):
            bad += 1
            print(f"FAIL {name}: columns spark={s_names} duck={d_names}")
            continue
        s_types = {f.name: SPARK2DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}
        d_types = {d[0]: str(d[1]) for d in cur.description}
        bad_types = [(c, s_types[c], d_types[c]) for c in s_names
                     if not d_types[c].upper().startswith(s_types[c])]
        if bad_types:
            print(f"TYPE {name}: {bad_types}")
        a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
        if len(a) != len(b):
            bad += 1
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}")
            continue
        if a != b:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: values differ ({len(a)} rows) cols={sorted(s_names)} e.g. {diff}"[:3000])
            continue
        ok += 1
        print(f"OK   {name}: {len(a)} rows ({ts:.1f}s)")
    print(f"== {ok} ok, {bad} failed")


if __name__ == "__main__":
    main()
