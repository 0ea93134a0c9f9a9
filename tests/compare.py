"""Run registered queries next to their SQL and compare every value.

    python tests/compare.py <table folder> [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("lineitem", "events", "documents", "embeddings", "pages")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value: object) -> tuple[str, object]:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    return (type(value).__name__, value)


def as_rows(columns: list[str], rows: list) -> tuple[list[str], list]:
    """Columns by name and rows in value order."""
    places = sorted(range(len(columns)), key=columns.__getitem__)
    plain = sorted(tuple(_plain(row[at]) for at in places) for row in rows)
    return [columns[at] for at in places], plain


def spark_rows(df) -> tuple[list[str], list]:
    return as_rows(df.columns, df.collect())


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list]:
    result = connection.execute(sql)
    return as_rows([column[0] for column in result.description], result.fetchall())


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as registered
    from tests.conftest import new_session

    spark = new_session()
    connection = connect(sf_dir)
    oracles = registered.oracle_sql()
    failed = 0
    for name, run in registered.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        got = spark_rows(run(spark, sf_dir))
        took = time.time() - started
        want = sql_rows(connection, oracles[name])
        same = got == want
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name} rows={len(got[1])}/{len(want[1])} {took:.1f}s", flush=True)
        if not same:
            print("  columns", got[0], want[0])
            missing, extra = set(want[1]) - set(got[1]), set(got[1]) - set(want[1])
            print("  only SQL  ", sorted(missing)[:2], "\n  only Spark", sorted(extra)[:2])
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
