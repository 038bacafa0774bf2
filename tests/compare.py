"""Runs registered queries against their SQL on DuckDB.

    python tests/compare.py [scale folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(repr(round(value, 9)))
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    result = con.execute(sql)
    return [c[0] for c in result.description], [c[1] for c in result.description], result.fetchall()


def compare(spark, folder: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"{len(rows)} rows, {took:.1f}s, no SQL"
    columns, kinds, expected = oracle_rows(folder, sql)
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    kinds = dict(zip(columns, map(str, kinds)))
    types = {f.name: f"{f.dataType.simpleString()}/{kinds[f.name]}" for f in df.schema}
    odd = {n: t for n, t in types.items() if t not in _SAME}
    mine, theirs = _sorted_rows(df.columns, rows), _sorted_rows(columns, expected)
    if mine != theirs:
        first = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
        return False, f"{len(mine)} vs {len(theirs)} rows, first difference {first}, types {odd}"
    return True, f"{len(rows)} rows, {took:.1f}s {odd or ''}"


_SAME = {"bigint/BIGINT", "int/INTEGER", "string/VARCHAR", "double/DOUBLE", "boolean/BOOLEAN"}


def main(argv: list[str]) -> int:
    from filmloom.session import build_session
    from filmloom.workload import QUERIES, SQL

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in argv[1:] or QUERIES:
        try:
            ok, note = compare(spark, folder, name, QUERIES[name], SQL.get(name))
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
