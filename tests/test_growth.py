"""Steps whose cost once grew faster than it had to, or by more than a task holds."""

import re

import pytest
from pyspark.sql import functions as F

from starloom import session, workspace
from starloom.operators import keys, ranges
from starloom.plans import star
from starloom.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS

HASH_JOINS = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dealing_to_many_ranges_is_compiled(spark, capsys):
    df = spark.range(20_000).select((F.col("id") % 997).cast("string").alias("a"), F.col("id").alias("b"))
    found = ranges.sampled(df, ["a", "b"], 400, per_range=8)
    assert found.count == 400
    with session.setting(spark, "spark.sql.adaptive.enabled", "false"):
        ranges.deal(df, found, ["a", "b"]).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    # The JVM leaves longer methods uncompiled.
    assert sizes and max(sizes) < 8_000


@pytest.mark.parametrize("per_range", [1, 7])
def test_search_finds_the_range_of_the_tree(spark, per_range):
    rows = [(None, None), ("", 1.5), ("a", None), ("a", 2.0), ("a", 2.5), ("b", -1.0), ("é", 0.0)] * 3
    df = spark.createDataFrame(rows, "s string, x double")
    for key in (["s", "x"], ["x", "s"], ["s"], ["x"]):
        found = ranges.sampled(df, key, 9, per_range=per_range)
        other = df.select("*", found.id_of(key).alias("expected"))
        dealt = ranges._with_range(other, found, key)
        assert dealt.where(~F.col(ranges.RANGE).eqNullSafe(F.col("expected"))).count() == 0


def test_bounds_keep_the_columns_that_tell_them_apart(spark):
    df = spark.range(4_000).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    assert ranges.sampled(df, ["a", "b"], 8).narrowed().schema.names == ["k0"]
    assert ranges.sampled(df, ["b", "a"], 8).narrowed().schema.names == ["k0", "k1"]


@pytest.mark.parametrize("hot", [0, 2])
def test_numbers_within_groups_take_no_join_afterwards(spark, hot):
    group = F.when(F.col("id") % 3 < hot, 5).when(F.col("id") % 100 != 99, F.col("id"))
    df = spark.range(6_000).select(group.alias("grp"), (F.col("id") * 17 % 6_001).alias("place"))
    found = keys.number_within(df, "n", "grp", ("place",), workspace.scratch(spark, "within"))
    assert "Join" not in plan_of(found) and "Exchange" not in plan_of(found)
    by_group = {}
    for row in found.collect():
        by_group.setdefault(row.grp, []).append((row.place, row.n))
    assert None not in by_group
    assert sum(map(len, by_group.values())) == df.where("grp IS NOT NULL").count()
    for rows in by_group.values():
        assert [n for _, n in sorted(rows)] == list(range(1, len(rows) + 1))


def test_small_partitions_are_hashed(spark):
    before = spark.conf.get(HASH_JOINS)
    spark.conf.set(HASH_JOINS, "0")
    try:
        with session.strict(spark), session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            left = spark.range(500).select((F.col("id") % 50).alias("k"), "id")
            joined = left.join(spark.range(50).select(F.col("id").alias("k")), "k")
            assert len(joined.collect()) == 500
            assert "ShuffledHashJoin" in plan_of(joined).split("== Initial Plan ==")[0]
        assert spark.conf.get(HASH_JOINS) == "0"
    finally:
        spark.conf.set(HASH_JOINS, before)


@pytest.mark.parametrize("column", ["order_delivered_customer_date", "order_estimated_delivery_date"])
@pytest.mark.parametrize("text", ["2020-01", "2020-13-01 00:00:00", "never"])
def test_delivery_texts_are_read_an_order_and_fail_an_item(spark, texts, tmp_path, column, text):
    def order(name):
        filled = {"order_id": name, "customer_id": "c", "order_purchase_timestamp": "2020-01-01 01:00:00", column: text}
        return [filled.get(c) for c in ORDERS.columns]

    item = {"order_id": "o1", "order_item_id": "1", "product_id": "p"}
    staged = {
        ORDERS.table: texts(ORDERS.columns, order("o1"), order("o2")),
        ORDER_ITEMS.table: texts(ORDER_ITEMS.columns, [item.get(c) for c in ORDER_ITEMS.columns]),
        CUSTOMERS.table: texts(CUSTOMERS.columns, ["c", *[None] * 4]),
        PRODUCTS.table: texts(PRODUCTS.columns, ["p", *[None] * 8]),
    }
    star.write_dimensions(spark, staged, str(tmp_path), star.temporal.now())
    rows = star.fact_rows(spark, staged, str(tmp_path))
    assert "unread_delivered" in plan_of(rows)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a full date"):
        rows.collect()
    dropped = staged | {ORDER_ITEMS.table: staged[ORDER_ITEMS.table].withColumn("product_id", F.lit("gone"))}
    assert star.fact_rows(spark, dropped, str(tmp_path)).collect() == []
