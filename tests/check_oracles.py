"""Compare every registered query with its SQL: python tests/check_oracles.py [sf] [names...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from mailsieve.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "as_tuple"):
        return round(float(value), 9)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(comparable(row[i]) for i in order) for row in rows]
    return sorted(table, key=repr)


def open_database(folder):
    database = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return database


def compare(spark, database, folder, name):
    """Returns (equal, message)."""
    start = time.time()
    frame = queries()[name](spark, folder)
    rows = [tuple(row) for row in frame.collect()]
    seconds = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {seconds:.1f}s"
    start = time.time()
    result = database.execute(sql)
    names = [column[0] for column in result.description]
    types = [str(column[1]) for column in result.description]
    expected = sorted_rows(names, result.fetchall())
    sql_seconds = time.time() - start
    found = sorted_rows(frame.columns, rows)
    timing = f"{seconds:.1f}s, sql {sql_seconds:.1f}s"
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} against {sorted(names)}"
    kinds = sorted(zip(frame.columns, [t for _, t in frame.dtypes], strict=True))
    pairs = [(c, k, t) for (c, k), (_, t) in zip(kinds, sorted(zip(names, types, strict=True)), strict=True)]
    if found != expected:
        wrong = [(a, b) for a, b in zip(found, expected, strict=False) if a != b][:2]
        return False, f"{len(found)} rows against {len(expected)}: {str(wrong)[:1500]}"
    return True, f"{len(rows)} rows, {timing} {pairs if os.environ.get('TYPES') else ''}"


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(
        "oracle-check",
        "local[8]",
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    database = open_database(folder)
    failed = []
    for name in sys.argv[2:] or queries():
        try:
            equal, message = compare(spark, database, folder, name)
        except Exception as error:
            equal, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if equal else "FAIL", name, message, flush=True)
        failed += [] if equal else [name]
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
