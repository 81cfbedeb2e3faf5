from pyspark.sql import functions as F

from starloom import workspace
from starloom.operators import keys


def numbered(spark, df, order_by):
    return keys.assign_keys(df, "key", order_by)


def test_dense_and_in_key_order(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).cast("string").alias("name"))
    found = numbered(spark, df, ("name",)).collect()
    assert len({r.name for r in found}) == 10_000
    by_key = sorted(found, key=lambda r: r.key)
    assert [r.key for r in by_key] == list(range(1, 10_001))
    assert [r.name for r in by_key] == sorted(r.name for r in found)


def test_several_partitions_are_used(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("name"), F.col("id").cast("int").alias("n"))
    order = ("name", "n")
    ordered = keys.numbered(df, keys.key_ranges(df, order), order, "key").select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in ordered.groupBy("p").count().collect()]
    # One name holds all rows, and still no partition holds most of them.
    assert len(sizes) == 4
    assert max(sizes) < 25_000


def test_second_column_orders_as_number(spark):
    df = spark.createDataFrame([("a", 10), ("a", 9), ("b", 1)], "name string, n int")
    found = numbered(spark, df, ("name", "n")).collect()
    assert sorted((r.key, r.name, r.n) for r in found) == [(1, "a", 9), (2, "a", 10), (3, "b", 1)]


def test_no_rows(spark):
    df = spark.createDataFrame([], "name string")
    assert numbered(spark, df, ("name",)).collect() == []


def test_repeated_keys_are_numbered_too(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("a",), (None,), (None,), ("c",)], "name string")
    found = numbered(spark, df, ("name",)).collect()
    assert [r.name for r in sorted(found, key=lambda r: r.key)] == [None, None, "a", "a", "a", "b", "c"]


def test_one_shuffle_is_read_twice(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("name"), (F.col("id") * 2).alias("other"))
    found = keys.assign_keys(df, "key", ("name",))
    assert len(found.collect()) == 5_000
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("Range (") == 1


def test_bounds_of_other_rows_only_change_the_sizes(spark):
    df = spark.range(3_000).select(F.col("id").cast("int").alias("n"))
    others = spark.range(100_000, 101_000).select(F.col("id").cast("int").alias("n"))
    for known in (others, others.limit(0), df):
        found = keys.numbered(df, keys.key_ranges(known, ("n",)), ("n",), "key").collect()
        assert sorted((r.key, r.n) for r in found) == [(i + 1, i) for i in range(3_000)]


def test_number_within(spark):
    # One group holds a third of the rows.
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("grp"),
        (F.col("id") * 17 % 3_001).alias("place"),
    )
    found = keys.number_within(df, "n", "grp", ("place",), workspace.scratch(spark, "within")).collect()
    hot = sorted((r.place, r.n) for r in found if r.grp == 0)
    assert [n for _, n in hot] == list(range(1, 1_001))
    assert all(r.n == 1 for r in found if r.grp != 0)
    assert len(found) == 3_000


def test_keys_survive_a_second_reading(spark):
    df = spark.range(1_000).select(F.col("id").cast("string").alias("name"))
    once = numbered(spark, df, ("name",))
    assert sorted(once.collect()) == sorted(once.repartition(3).collect())
