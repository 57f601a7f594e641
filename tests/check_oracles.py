"""Compare registered queries with their DuckDB oracles: python tests/check_oracles.py [sf_dir] [name...]"""

import datetime as dt
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, sf_dir, name):
    """None when the results agree, else what differs."""
    frame = entry_point.queries()[name](spark, sf_dir)
    got = rows_by_name(frame.columns, [tuple(row) for row in frame.collect()])
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    con.execute(sql)
    expected = rows_by_name([d[0] for d in con.description], con.fetchall())
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if got[1] != expected[1]:
        extra = sorted(set(got[1]) - set(expected[1]))[:2]
        missing = sorted(set(expected[1]) - set(got[1]))[:2]
        return f"{len(got[1])} rows, expected {len(expected[1])}; extra {str(extra)[:700]}; missing {str(missing)[:700]}"
    return None if got[1] else "no rows"


def main():
    from tapeloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(
        "oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in sys.argv[2:] or entry_point.queries():
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed, {dt.datetime.now():%H:%M:%S}")


if __name__ == "__main__":
    main()
