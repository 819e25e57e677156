"""Run registered queries beside their SQL: ``python tests/check.py <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str, files: str = "") -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet{files}')"
        )
    return connection


def _value(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_value(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row),
    )


def differences(spark_df, connection, sql) -> list[str]:
    """What differs between a query and its SQL; empty when they agree."""
    relation = connection.execute(sql)
    sql_columns = [c[0] for c in relation.description]
    sql_rows = relation.fetchall()
    spark_rows = [tuple(r) for r in spark_df.collect()]
    if sorted(sql_columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(sql_columns)}"]
    ours = sorted_rows(spark_df.columns, spark_rows)
    theirs = sorted_rows(sql_columns, sql_rows)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return [f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}"] if wrong else []


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from spendlake.session import get_spark

    folder = tempfile.TemporaryDirectory(prefix="check-")
    spark = get_spark("check", "local[8]", {"spark.checkpoint.dir": folder.name})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                found = differences(df, connection, sqls[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
