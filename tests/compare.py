"""Spark result against DuckDB result: same columns, same multiset of rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        result = db.execute(sql)
        return [c[0] for c in result.description], result.fetchall()


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return str(value)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df: DataFrame, folder: str, sql: str) -> str:
    """Empty when equal, else what differs."""
    columns, expected = oracle_rows(folder, sql)
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    ours, theirs = _bag(spark_df.columns, spark_df.collect()), _bag(columns, expected)
    if ours == theirs:
        return ""
    extra, lacking = ours - theirs, theirs - ours
    return f"{sum(extra.values())} extra, {sum(lacking.values())} lacking of {len(expected)}: " + (
        f"{list(extra)[:3]} / {list(lacking)[:3]}"
    )


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            found = difference(query(session, folder), folder, entry.oracle_sql()[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - started:6.2f}s {found or 'ok'}", flush=True)
