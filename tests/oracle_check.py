"""Compare every registered query with its SQL oracle on DuckDB."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    return names, _sorted([tuple(_plain(v) for v in r) for r in frame.select(*names).collect()])


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    ordered = relation.select(*[duckdb.ColumnExpression(n) for n in names])
    return names, _sorted([tuple(_plain(v) for v in r) for r in ordered.fetchall()])


def compare(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    got_names, got = spark_rows(entry.queries()[name](spark, folder))
    spent = time.time() - started
    want_names, want = oracle_rows(connection, entry.oracle_sql()[name])
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return False, f"{len(got)} rows against {len(want)}; got {extra}, expected {missing}"
    return True, f"{len(got)} rows, {spent:.1f} s"


if __name__ == "__main__":
    from conftest import local_session

    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session, duck = local_session(), connect(data)
    for key in sys.argv[2:] or entry.oracle_sql():
        try:
            print(key, *compare(session, duck, data, key), flush=True)
        except Exception as error:  # noqa: BLE001
            print(key, "ERROR", str(error)[:1500], flush=True)
