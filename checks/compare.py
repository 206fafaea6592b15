"""Run queries against their DuckDB form: ``python -m checks.compare [folder] [name ...]``."""

import sys
import time

import duckdb

from checks import catalog
from tapeloom.settings import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return connection


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, connection, folder, name):
    """None if equal, else a short text; also the number of rows."""
    frame = catalog.QUERIES[name](spark, folder)
    mine = [tuple(r) for r in frame.collect()]
    result = connection.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    theirs = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}", len(mine)
    a, b = sorted_rows(mine, frame.columns), sorted_rows(theirs, columns)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b), key=repr)[:2], sorted(set(b) - set(a), key=repr)[:2]
        return f"rows {len(a)} / {len(b)}\n   spark {only_a}\n   duck  {only_b}", len(a)
    return None, len(a)


def main(folder="/root/testdata/sf0.01", *names):
    spark = local_session(8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    failed = 0
    for name in names or catalog.ORACLES:
        start = time.time()
        try:
            problem, count = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem, count = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {count} rows {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(*sys.argv[1:])
