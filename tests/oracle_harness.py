"""Compare each `queries()` result with its `oracle_sql()` twin in DuckDB.

Checks row count, column names, column types (mapped between engines) and
the multiset of rows (order-insensitive; doubles rounded to 6 digits).
Run directly: `python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]`.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

import __spark_entry__ as E  # noqa: E402
from flowstats.sources.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, Decimal):
        return int(v) if v == int(v) else float(v)
    return v


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    sql = E.oracle_sql().get(name)
    result = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        result["oracle"] = "none"
        return result
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    result["oracle_rows"] = len(d_rows)
    result["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not result["columns_match"]:
        result["spark_cols"] = sorted(s_cols)
        result["oracle_cols"] = sorted(d_cols)
        result["match"] = False
        return result
    type_diff = {
        c: (s_types[c], d_types[c]) for c in s_cols if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types[c]
    }
    result["type_diff"] = type_diff
    sc, dc = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    result["values_match"] = sc == dc
    if sc != dc:
        result["only_spark"] = list((sc - dc).elements())[:3]
        result["only_oracle"] = list((dc - sc).elements())[:3]
    result["match"] = result["values_match"] and len(s_rows) == len(d_rows) and not type_diff
    return result


def main(argv: list[str]) -> int:
    from flowstats.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck_connection(sf_dir)
    bad = 0
    for name in names:
        try:
            r = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and go on
            r = {"name": name, "match": False, "error": repr(exc)[:600]}
        bad += not r.get("match", r.get("oracle") == "none")  # no twin: rows only
        print(r, flush=True)
    print(f"mismatches: {bad} of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
