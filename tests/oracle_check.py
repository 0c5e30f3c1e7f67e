"""Run registered queries next to their SQL on DuckDB and compare all rows.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(float(f"{value:.10g}"))
    return "NULL" if value is None else f"{type(value).__name__}:{value}"


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a short description of the difference."""
    frame = query(spark, sf_dir)
    mine = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if not theirs:
        return "no rows to compare"
    if mine == theirs:
        return None
    ours, other = set(mine), set(theirs)
    return f"rows {len(mine)}/{len(theirs)} only here {sorted(ours - other)[:2]} only there {sorted(other - ours)[:2]}"


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    chosen = sys.argv[2:] or list(queries())
    for name in chosen:
        start = time.time()
        try:
            verdict = compare(spark, con, name, queries()[name], sql[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:700]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name:28s} {time.time() - start:5.1f}s {verdict or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
