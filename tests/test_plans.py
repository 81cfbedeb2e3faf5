from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import workspace
from starloom.operators import keys
from starloom.plans import dimensions, fact, reports, star
from starloom.schemas import (
    CUSTOMERS,
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    DIM_TIME,
    FACT_ORDERS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    TARGETS,
)
from starloom.sources import sample_tables as samples

SMALL = "/root/testdata/sf0.001"
NOW = datetime(2020, 1, 2, 3, 4, 5)


def order(order_id, customer="c1", bought="2017-10-02 10:56:33", delivered=None, due=None):
    return (order_id, customer, "delivered", bought, None, None, delivered, due)


def item(order_id, number="1", product="p1", price="10.00", freight="1.00"):
    return (order_id, number, product, "s1", None, price, freight)


@pytest.fixture
def build(spark, texts):
    """Write a star from literal orders and items; returns its tables by name."""

    def make(orders, items, customers=("c1",), products=("p1",)):
        staged = {
            ORDERS.table: texts(ORDERS.columns, *orders),
            ORDER_ITEMS.table: texts(ORDER_ITEMS.columns, *items),
            CUSTOMERS.table: texts(
                CUSTOMERS.columns, *[(c, "u" + c, "01234", " são paulo ", "sp") for c in customers]
            ),
            PRODUCTS.table: texts(
                PRODUCTS.columns, *[(p, " cool_stuff ", *[None] * 3, " 5 ", " ", None, "2.5") for p in products]
            ),
        }
        folder = workspace.scratch(spark, "test")
        star.write_star(spark, staged, folder, NOW)
        return {t.table: star.read_table(spark, folder, t) for t in TARGETS}

    return make


def test_whole_row(build):
    tables = build(
        [order("o1", delivered="2017-10-10 09:00:00", due="2017-10-18 05:06:07")],
        [item("o1", number=" 12 ", price=" 9.995 ")],
    )
    assert [tuple(r) for r in tables["fact_orders"].collect()] == [
        (
            1,
            "o1",
            12,
            1,
            1,
            1,
            Decimal("10.00"),
            Decimal("1.00"),
            Decimal("11.00"),
            "delivered",
            datetime(2017, 10, 2, 10, 56, 33),
            datetime(2017, 10, 10, 9),
            datetime(2017, 10, 18),
            7,
            NOW,
        )
    ]
    assert [tuple(r) for r in tables["dim_products"].collect()] == [
        (1, "p1", "Cool Stuff", None, Decimal("5.0000"), None, None, Decimal("2.5000"), NOW)
    ]
    assert [tuple(r) for r in tables["dim_customers"].collect()] == [
        (1, "c1", "uc1", "01234", "São Paulo", "SP", NOW)
    ]
    assert [tuple(r) for r in tables["dim_time"].collect()] == [
        (1, date(2017, 10, 2), 2017, 4, 10, "October  ", 40, 2, 1, "Monday   ", False)
    ]


def test_written_types(build):
    tables = build([order("o1")], [item("o1")])
    for target in TARGETS:
        stored = tables[target.table]
        assert [(f.name, f.dataType) for f in stored.schema] == [
            (f.name, f.dataType) for f in target.schema
        ]


def test_one_load_time_for_all_rows(build):
    tables = build([order("o1"), order("o2")], [item("o1"), item("o2")])
    for name in ("fact_orders", "dim_customers", "dim_products"):
        assert {r.created_at for r in tables[name].collect()} == {NOW}
    assert "created_at" not in tables["dim_time"].columns


def test_items_without_a_match_are_dropped(build):
    tables = build(
        [order("o1"), order("o2", customer="gone"), order("o3", customer=None)],
        [
            item("o1"),
            item("o1", number="2", product="gone"),
            item("o1", number="3", product=None),
            item("o2"),
            item("o3"),
            item("gone"),
            item(None),
        ],
    )
    found = tables["fact_orders"].collect()
    assert [(r.order_id, r.order_item_id) for r in found] == [("o1", 1)]


def test_bad_text_fails_only_where_a_row_is_kept(build):
    orders = [order("o1"), order("o2", customer="gone", delivered="never")]
    dropped = item("o2", number="x", price="much")
    assert build(orders, [item("o1"), dropped])["fact_orders"].count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a full date"):
        build([order("o1")], [item("o1", price="much")])


@pytest.mark.parametrize("bought", ["   ", "2017-10-02 garbage"])
def test_bad_purchase_time_fails(build, bought):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a full date"):
        build([order("o1", bought=bought)], [item("o1")])


def test_missing_item_number_fails(build):
    with pytest.raises(ValueError, match=r"not_null\(order_item_id\): 1 violations"):
        build([order("o1")], [item("o1", number=None)])


def test_equal_item_numbers_fail(build):
    # Different texts, the same number.
    with pytest.raises(ValueError, match=r"unique\(order_id, order_item_id\): 1 violations"):
        build([order("o1")], [item("o1", number="1"), item("o1", number=" 01 ")])


def test_prices_without_text(build):
    rows = [item("o1", price="  "), item("o1", number="2", freight=None)]
    found = build([order("o1")], rows)["fact_orders"].orderBy("order_item_id").collect()
    assert [(r.price, r.freight_value, r.total_revenue) for r in found] == [
        (None, Decimal("1.00"), None),
        (Decimal("10.00"), None, None),
    ]


def test_dates_come_from_all_orders_and_no_others(texts):
    orders = texts(
        ORDERS.columns,
        order("o1", bought="2017-01-01 23:59:59"),
        order("o2", bought="2017-01-01 00:00:00"),
        order("o3", bought="2017-01-04 00:00:00"),
        order("o4", bought=None),
    )
    found = dimensions.calendar(dimensions.purchase_dates(orders)).orderBy("full_date").collect()
    assert [r.full_date for r in found] == [date(2017, 1, 1), date(2017, 1, 4)]
    # The first day of 2017 belongs to the last ISO week of the year before.
    assert tuple(found[0])[1:] == (2017, 1, 1, "January  ", 52, 1, 7, "Sunday   ", True)


def test_orders_without_items_have_their_date(build):
    tables = build([order("o1"), order("o2", bought="2018-02-03 00:00:00")], [item("o1")])
    assert tables["dim_time"].count() == 2


def test_order_of_number_keys_is_numeric_within_an_order(build):
    rows = [item("o1", number=str(n)) for n in (10, 9, 1)]
    found = build([order("o1")], rows)["fact_orders"].collect()
    assert sorted((r.order_item_key, r.order_item_id) for r in found) == [(1, 1), (2, 9), (3, 10)]


def test_invariants_on_sample_tables(spark):
    staged = samples.with_unknown_parents(samples.staging(spark, SMALL))
    folder = workspace.scratch(spark, "test")
    counts = star.write_star(spark, staged, folder, NOW)
    tables = {t.table: star.read_table(spark, folder, t) for t in TARGETS}
    for target in TARGETS:
        key = F.col(target.key)
        n, distinct, low, high = (
            tables[target.table]
            .agg(F.count(key), F.count_distinct(key), F.min(key), F.max(key))
            .first()
        )
        assert (distinct, low, high) == (n, 1, n)
        assert counts[target.table] == n
    facts = tables["fact_orders"]
    both = F.col("price").isNotNull() & F.col("freight_value").isNotNull()
    unequal = F.col("total_revenue") != F.col("price") + F.col("freight_value")
    assert facts.where(both & unequal).count() == 0
    assert facts.where(~both & F.col("total_revenue").isNotNull()).count() == 0
    losses = fact.join_losses(
        staged[ORDER_ITEMS.table],
        staged[ORDERS.table],
        *[tables[t.table] for t in (DIM_CUSTOMERS, DIM_PRODUCTS, DIM_TIME)],
    )
    steps = {r.step: r.kept_rows for r in losses.collect()}
    assert steps["items"] == 6000
    assert steps["time"] == counts["fact_orders"] < steps["items"]


def test_report_with_undelivered_and_unpriced_items(build):
    tables = build(
        [order("o1", delivered="2017-10-04 10:56:33"), order("o2")],
        [item("o1"), item("o2", price=None)],
    )
    report = reports.revenue_by_month_category(
        tables["fact_orders"], tables["dim_products"], tables["dim_time"]
    )
    assert [tuple(r) for r in report.collect()] == [
        (2017, 10, "Cool Stuff", 2, Decimal("11.00"), 2.0)
    ]


# Plans.


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(spark):
    """Staging and dimensions as written tables."""
    folder = workspace.scratch(spark, "test")
    staged = {}
    for table, frame in samples.staging(spark, SMALL).items():
        frame.write.parquet(f"{folder}/{table}")
        staged[table] = spark.read.schema(frame.schema).parquet(f"{folder}/{table}")
    star.write_dimensions(spark, staged, folder, NOW)
    return staged, folder


def test_fact_plan(spark, written):
    staged, folder = written
    plan = plan_of(star.fact_rows(spark, staged, folder))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan
    # Small dimensions are broadcast because their files are small; columns the fact
    # does not need are not read.
    assert plan.count("BroadcastHashJoin") >= 3
    assert "seller_id" not in plan and "order_approved_at" not in plan
    assert "PushedFilters: [IsNotNull(order_id), IsNotNull(product_id)]" in plan


def test_large_dimensions_are_joined_by_key(spark, written):
    staged, folder = written
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(star.fact_rows(spark, staged, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan
    assert plan.count("SortMergeJoin") == 4


def test_hot_product_is_split(spark, written):
    """A product with a third of all items is joined by several tasks."""
    staged, folder = written
    hot = F.when(F.col("order_id").cast("int") % 3 == 0, "7").otherwise(F.col("product_id"))
    items = staged[ORDER_ITEMS.table].withColumn("product_id", hot)
    place = workspace.scratch(spark, "hot")
    # Two hundred files: a hot partition is split between the files it came from.
    items.repartition(50).write.parquet(place)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.files.openCostInBytes": "16m",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        products = star.read_table(spark, folder, DIM_PRODUCTS)
        joined = fact.items_with_keys(spark.read.parquet(place), products)
        shuffled = joined.repartition("order_id")
        count = len(shuffled.collect())
        plan = plan_of(shuffled)
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting) if setting is not None else spark.conf.unset(name)
    assert count == 6000
    assert "skew=true" in plan


def test_calendar_is_distinct_on_the_date_alone(spark):
    plan = plan_of(dimensions.calendar(dimensions.purchase_dates(samples.orders(spark, SMALL))))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(full_date" in line]
    assert len(shuffles) == 1
    keys = [line for line in plan.splitlines() if "HashAggregate(keys=[full_date" in line]
    assert len(keys) == 2 and all("keys=[full_date#" in k and "," not in k.split("]")[0] for k in keys)


def test_the_fact_is_joined_once(spark, written):
    """Rows are counted and numbered from one shuffle, so nothing before it runs twice."""
    staged, folder = written
    rows = star.fact_rows(spark, staged, folder)
    found = keys.key_ranges(fact.item_keys(staged[ORDER_ITEMS.table]), FACT_ORDERS.natural_key)
    numbered = keys.numbered(rows, found, FACT_ORDERS.natural_key, "key")
    assert len(numbered.collect()) == 6000
    final = plan_of(numbered).split("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if "Exchange shufflepartitionidpassthrough" in line]
    assert [("ReusedExchange" in line) for line in dealt].count(False) == 1
    assert sum("ReusedExchange" in line for line in dealt) == 1
    # Date, customer, product and order once each, and the ranges' first numbers.
    joins = [line for line in final.splitlines() if "Join " in line and "HashJoin" in line or "SortMergeJoin" in line]
    assert len(joins) == 5


def test_titles_are_made_once(spark):
    customers = dimensions.customers(samples.customers(spark, SMALL))
    numbered = keys.numbered(customers, keys.key_ranges(customers, ("customer_id",)), ("customer_id",), "key")
    numbered.collect()
    final = plan_of(numbered).split("== Initial Plan ==")[0]
    assert final.count("initcap") == 1 or "ReusedExchange" in final
    # Finding the ranges reads the key alone.
    assert "initcap" not in plan_of(customers.select("customer_id"))


def test_fact_is_registered_layout(written, spark):
    staged, folder = written
    rows = star.fact_rows(spark, staged, folder)
    assert rows.columns == [f.name for f in FACT_ORDERS.fields]
    assert star.read_table(spark, folder, DIM_TIME).columns == DIM_TIME.schema.names
