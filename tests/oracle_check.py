"""Compare registered queries with their SQL twins.

    python tests/oracle_check.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """A value in a form both engines share."""
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(table, key=repr)


def compare(spark, con, sf_dir, build, sql):
    """None when both agree, else a short description of the difference."""
    frame = build(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    mine, other = set(ours[1]), set(theirs[1])
    return (
        f"{len(ours[1])} rows != {len(theirs[1])} rows; only ours {list(mine - other)[:2]}; "
        f"only theirs {list(other - mine)[:2]}"
    )


def main(sf_dir, *names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, build, sql[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s", problem or "")
    print("failures:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
