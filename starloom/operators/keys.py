"""Dense surrogate keys 1..N in natural-key order, without a single-task sort.

The rows are dealt once to ranges of keys known beforehand. A range's rows are counted
behind that shuffle, the ranges' first numbers are a running sum over one row a range, and
the same shuffled rows are then numbered inside their range. Both belong to one query, which
reads the shuffle twice and runs what lies before it once; nothing is written in between.
A number follows from the bounds and the rows' keys alone, so a lost executor cannot change it.

A large frame can be numbered in runs of neighbouring ranges, a query each: the shuffle files of
a run can go before the next one begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starloom.operators import ranges
from starloom.operators.ranges import RANGE, SAMPLED_PER_RANGE, Ranges, Run

# monotonically_increasing_id counts the rows of a partition in its lower bits.
_ROW_MASK = (1 << 33) - 1

# Rows numbered in one run. Every run reads the whole frame, so their number is bounded; of a
# larger frame a run then holds its share.
ROWS_A_RUN = 1 << 25
MOST_RUNS = 8


def key_ranges(keys: DataFrame, order_by: Sequence[str]) -> Ranges:
    """As many ranges as there are shuffle partitions, fewer for few rows."""
    count = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.sampled(keys, order_by, count).narrowed()


def key_runs(keys: DataFrame, order_by: Sequence[str]) -> list[Run]:
    """Ranges in as many runs as the rows take, each of as many ranges as there are shuffle
    partitions. More runs share the same sample, so a range of theirs has fewer keys of it."""
    count = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = ranges.drawn(keys, order_by, count * SAMPLED_PER_RANGE)
    runs = min(MOST_RUNS, max(1, -(-sample.rows // ROWS_A_RUN)))
    return sample.ranges(count * runs, SAMPLED_PER_RANGE // runs).narrowed().runs(runs)


def numbered(df: DataFrame, of: Ranges, order_by: Sequence[str], name: str, after: int = 0) -> DataFrame:
    """``df`` with a leading key column, which begins behind ``after``, sorted inside each partition."""
    dealt = ranges.deal(df, of, order_by)
    # The digest reads every column. Without it the count's side of the plan would shuffle
    # fewer of them, and so would need a shuffle, and a run of ``df``, of its own.
    counted = dealt.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_rows"), F.max(F.xxhash64(*df.columns)).alias("_digest"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.where(F.col("_digest").isNotNull()).select(
        RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # A partition is a range, so the place in it is the place in the range.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)).alias("_place")
    placed = dealt.sortWithinPartitions(*order_by).select("*", place)
    # One row a range, as many as partitions.
    return placed.join(F.broadcast(starts), RANGE).select((F.col("_start") + F.col("_place") + (after + 1)).alias(name), *df.columns)


def assign_keys(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """``df`` with a leading key column; the key columns of ``df`` are read once more before."""
    return numbered(df, key_ranges(df, order_by), order_by, name)


def number_within(
    df: DataFrame, name: str, group: str, order_by: Sequence[str], folder: str
) -> DataFrame:
    """1..n inside each group, in the given total order; ``folder`` receives the numbered rows.
    Rows without a group are left out.

    A window over the group would put a hot group into one task. Here the rows are dealt to
    ranges of group and order, and numbered inside a range. A group lies in several ranges
    only if it is that of several bounds: its rows in the ranges before, one row a range, are
    then added.
    """
    order = (group, *order_by)
    grouped = df.where(F.col(group).isNotNull())
    of = key_ranges(grouped, order)
    dealt = ranges.deal(grouped, of, order)
    # The range is in the window's key, so the rows stay where they were dealt to. It comes
    # second: Spark sorts by the leading eight bytes first, and a partition has one range.
    place = F.row_number().over(Window.partitionBy(group, RANGE).orderBy(*order_by))
    placed = dealt.select("*", place.cast("bigint").alias("_place"))
    number = F.col("_place")
    if len(of.schema) > 1:
        split = list({bound[0] for bound in of.bounds})
        counts = dealt.where(F.col(group).isin(split)).groupBy(RANGE, group).agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.partitionBy(group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        earlier = counts.select(RANGE, group, F.sum("_rows").over(before).alias("_before"))
        placed = placed.join(F.broadcast(earlier), [RANGE, group], "left")
        number = F.coalesce("_before", F.lit(0)) + number
    within = placed.select(*df.columns, number.alias(name))
    within.write.parquet(folder)
    return df.sparkSession.read.schema(within.schema).parquet(folder)
