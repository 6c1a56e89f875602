"""Runs registered queries next to their SQL on one table directory.

As a script: python tests/compare.py <table directory> [query ...]
"""

from __future__ import annotations

import collections
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def sql_result(connection, sql: str) -> tuple[list[str], collections.Counter]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = collections.Counter(tuple(repr(r[i]) for i in order) for r in cursor.fetchall())
    return sorted(columns), rows


def spark_result(df) -> tuple[list[str], collections.Counter]:
    columns = df.columns
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), collections.Counter(tuple(repr(r[i]) for i in order) for r in df.collect())


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    """A description of the first difference, or None."""
    got_columns, got = spark_result(spark_entry.queries()[name](spark, sf_dir))
    want_columns, want = sql_result(connection, spark_entry.oracle_sql()[name])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"only spark {list((got - want).items())[:2]}; only sql {list((want - got).items())[:2]}"
        )
    return None


def main() -> int:
    from snapmart.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(spark_entry.queries())
    spark, connection, failed = local_session(8), duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
