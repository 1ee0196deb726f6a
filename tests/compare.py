"""Runs queries on Spark and DuckDB and compares the results."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("SET max_temp_directory_size = '4GB'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def spark_result(spark, name: str, folder: str):
    df = queries()[name](spark, folder)
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, name: str):
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    return canonical(columns, result.fetchall())


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when equal, otherwise what differs first."""
    ours, theirs = spark_result(spark, name, folder), oracle_result(con, name)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    left = sorted(set(ours[1]) - set(theirs[1]))[:2]
    right = sorted(set(theirs[1]) - set(ours[1]))[:2]
    return f"{len(ours[1])} against {len(theirs[1])} rows; only here {left}; only there {right}"


def main() -> None:
    from plazaflow.config import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(queries())
    spark = build_session("compare", "local[8]")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                verdict = difference(spark, con, name, folder) or "equal"
            else:
                verdict = f"{len(spark_result(spark, name, folder)[1])} rows, no oracle"
        except Exception as e:
            verdict = f"error {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
