"""Building and writing the star: dimensions first, then the fact that reads them back."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from starloom import session
from starloom.functions import temporal
from starloom.operators import constraints, keys
from starloom.operators.ranges import Run
from starloom.plans import dimensions, fact
from starloom.schemas import (
    CUSTOMERS,
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    DIM_TIME,
    DIMENSIONS,
    FACT_ORDERS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    TARGETS,
    Target,
)


def read_table(spark: SparkSession, folder: str, target: Target) -> DataFrame:
    return spark.read.schema(target.schema).parquet(f"{folder}/{target.table}")


def write_table(
    spark: SparkSession,
    target: Target,
    rows: DataFrame,
    folder: str,
    loaded_at: datetime,
    checked: bool = True,
) -> int:
    """Number and write one table of rows with the natural key and the other columns, and check
    its rows; their count. See :func:`write_runs`."""
    runs = keys.key_runs(rows, target.natural_key)
    return write_runs(spark, target, runs, lambda run: run.of(rows, target.natural_key[0]), folder, loaded_at, checked)


def write_runs(
    spark: SparkSession,
    target: Target,
    runs: Sequence[Run],
    rows_of: Callable[[Run], DataFrame],
    folder: str,
    loaded_at: datetime,
    checked: bool = True,
) -> int:
    """Number and write one table run by run, and check its rows; their count.

    The rows of a run are run and written once, and the rules on rows are counted by the write.
    Every run is a query that adds its files to the table. Unchecked, a table that breaks the
    rules is left as it is, for a report; else that is an error, and what was written is for
    the caller to remove.
    """
    found: Counter[str] = Counter()
    for run in runs:
        numbered = keys.numbered(rows_of(run), run.ranges, target.natural_key, target.key, after=found[constraints.ROWS])
        seen = Observation()
        numbered = numbered.observe(seen, *constraints.observed_rules(target))
        if target.stamped:
            # As text: a Python time would pass through the driver's own zone.
            stamp = temporal.wall_clock(F.lit(str(loaded_at)))
            numbered = numbered.withColumn("created_at", stamp)
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema]
        mode = "errorifexists" if run.low is None else "append"
        numbered.select(*columns).write.mode(mode).parquet(f"{folder}/{target.table}")
        found.update(seen.get)
    if checked:
        constraints.enforce(target, found)
    return found[constraints.ROWS]


def write_dimensions(
    spark: SparkSession,
    staged: Mapping[str, DataFrame],
    folder: str,
    loaded_at: datetime,
    only: tuple[Target, ...] = DIMENSIONS,
) -> dict[str, int]:
    rows = {
        DIM_CUSTOMERS.table: lambda: dimensions.customers(staged[CUSTOMERS.table]),
        DIM_PRODUCTS.table: lambda: dimensions.products(staged[PRODUCTS.table]),
        DIM_TIME.table: lambda: dimensions.calendar(dimensions.purchase_dates(staged[ORDERS.table])),
    }

    def write(target: Target) -> int:
        return write_table(spark, target, rows[target.table](), folder, loaded_at)

    return dict(zip([t.table for t in only], session.side_by_side(spark, write, only)))


def fact_rows(spark: SparkSession, staged: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Fact rows against the dimensions written under ``folder``."""
    return fact.order_items(
        staged[ORDER_ITEMS.table],
        staged[ORDERS.table],
        read_table(spark, folder, DIM_CUSTOMERS),
        read_table(spark, folder, DIM_PRODUCTS),
        read_table(spark, folder, DIM_TIME),
    )


def write_fact(
    spark: SparkSession,
    staged: Mapping[str, DataFrame],
    folder: str,
    loaded_at: datetime,
    checked: bool = True,
) -> int:
    """The fact, in key ranges found from the staged items, which cost less to read than its
    rows; rows written."""
    items, orders = staged[ORDER_ITEMS.table], staged[ORDERS.table]

    def rows_of(run: Run) -> DataFrame:
        # Both sides of the join: Spark passes the limits on to the other side only so far.
        part = {ORDER_ITEMS.table: run.of(items, "order_id"), ORDERS.table: run.of(orders, "order_id")}
        return fact_rows(spark, {**staged, **part}, folder)

    runs = keys.key_runs(fact.item_keys(items), FACT_ORDERS.natural_key)
    return write_runs(spark, FACT_ORDERS, runs, rows_of, folder, loaded_at, checked)


def write_star(
    spark: SparkSession,
    staged: Mapping[str, DataFrame],
    folder: str,
    loaded_at: datetime | None = None,
    written: Callable[[], None] | None = None,
) -> dict[str, int]:
    """All four tables under ``folder``, with one load time for all rows; rows per table.

    Keys and references are checked on what was written, all in one scan of the tables unless
    those are large. ``written`` is called before that, once the staged rows are no longer needed.
    """
    loaded_at = loaded_at or temporal.now()
    counts = write_dimensions(spark, staged, folder, loaded_at)
    counts[FACT_ORDERS.table] = write_fact(spark, staged, folder, loaded_at)
    if written:
        written()
    tables = {t.table: read_table(spark, folder, t) for t in TARGETS}
    constraints.enforce_keys(tables, TARGETS, rows=sum(counts.values()))
    return counts
