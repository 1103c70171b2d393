"""Compare registered Spark queries with their SQL twins in DuckDB: names, types, rows.

Usage: python tests/oracle_compare.py <folder of tables> [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
FAMILY = {
    "bigint": "int", "int": "int", "smallint": "int", "string": "str", "double": "float", "boolean": "bool",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "VARCHAR": "str", "DOUBLE": "float", "BOOLEAN": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (Decimal, dt.datetime)):
        return str(v)
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    types = {c[0]: FAMILY.get(str(c[1]), str(c[1])) for c in cur.description}
    expected = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    out = []
    spark_types = {n: FAMILY.get(t, t) for n, t in df.dtypes}
    if spark_types != types:
        out.append(f"types {[(n, spark_types[n], types[n]) for n in types if types[n] != spark_types[n]]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(names, expected)
    if got != want:
        a, b = set(got), set(want)
        out.append(f"rows {len(got)} / {len(want)}; only spark {sorted(a - b)[:2]}; only sql {sorted(b - a)[:2]}"[:1500])
    return out


def main() -> None:
    from themeloom.plans.oracle import ORACLE
    from themeloom.plans.queries import QUERIES
    from themeloom.session import build_session

    spark = build_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sys.argv[1]), 0
    for name, q in QUERIES.items():
        if sys.argv[2:] and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        t = time.time()
        try:
            diff = differences(q(spark, sys.argv[1]), con, ORACLE[name]) if name in ORACLE else ["no sql"]
        except Exception as e:  # noqa: BLE001
            diff = [f"{type(e).__name__} {e}"[:900]]
        bad += bool(diff)
        print(f"{name:32s} {time.time() - t:6.2f}s {'ok' if not diff else ' ; '.join(diff)}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
