"""Run registered queries against their check queries in DuckDB.

Also a command: ``python tests/compare.py SF_DIR [name ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def differences(spark, connection, sf_dir: str, run, sql: str) -> list[str]:
    """What differs between the two results; empty if they agree."""
    frame = run(spark, sf_dir)
    rows = frame.collect()
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(set(frame.columns) ^ set(names))}"]
    order = sorted(names)
    ours = Counter(tuple(repr(r[c]) for c in order) for r in rows)
    theirs = Counter(tuple(repr(r[names.index(c)]) for c in order) for r in expected)
    if len(rows) != len(expected):
        problems.append(f"rows {len(rows)} <> {len(expected)}")
    for name, only in (("spark", ours - theirs), ("duckdb", theirs - ours)):
        if only:
            problems.append(f"only in {name}: {sum(only.values())}, e.g. {dict(zip(order, min(only)))}")
    return problems


def local_session(cpus: str = "8"):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fraudlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def main() -> None:
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = local_session(), connect(sf_dir)
    checks = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in checks:
                problems = differences(spark, connection, sf_dir, run, checks[name])
            else:
                problems = [] if run(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error).splitlines()[0][:300]}"]
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - started:.1f}s", *problems, sep="\n     ", flush=True)


if __name__ == "__main__":
    main()
