"""Runs registered queries and their SQL side by side and compares all values."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql):
    """None when equal, else what differs."""
    left_cols, left = table_of(df.columns, df.collect())
    cur = con.execute(sql)
    right_cols, right = table_of([c[0] for c in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            pair = [(c, x, y) for c, x, y in zip(left_cols, a, b) if x != y]
            return f"values differ: {str(pair)[:400]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                result = compare(con, fn(spark, sf_dir), sqls[name]) or "ok"
            else:
                result = f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as e:  # report and go on with the next query
            result = f"ERROR {type(e).__name__}: {str(e)[:500]}"
        bad += not (result == "ok" or result.startswith("rows only"))
        print(f"{name:28s} {time.time() - start:6.2f}s {result}", flush=True)
    print("not matching:", bad)


if __name__ == "__main__":
    main()
