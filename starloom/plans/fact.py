"""The order-item fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import numeric, temporal
from starloom.plans import dimensions


def with_date_key(orders: DataFrame, time: DataFrame) -> DataFrame:
    """Orders with a purchase date, its text replaced by the timestamp, and the date's key."""
    # An order without a purchase time can match no date, so it is out already here.
    others = [c for c in orders.columns if c != "order_purchase_timestamp"]
    placed = dimensions.purchased(orders).select(
        *others,
        temporal.wall_clock(F.col("order_purchase_timestamp")).alias("purchase_timestamp"),
    )
    dated = placed.withColumn("full_date", F.col("purchase_timestamp").cast("date"))
    return dated.join(time.select("full_date", "time_key"), "full_date")


def with_customer_key(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers.select("customer_id", "customer_key"), "customer_id")


def orders_with_keys(orders: DataFrame, customers: DataFrame, time: DataFrame) -> DataFrame:
    """Orders that have a known customer and a purchase date, with both keys.

    Joined before the items come in: there are several items per order, and each of them
    would otherwise travel once more. No broadcast is asked for; Spark takes one where
    the written dimension is measured small, as the date dimension always is.
    """
    needed = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return with_customer_key(with_date_key(needed, time), customers).drop("full_date", "customer_id")


def identified(items: DataFrame) -> DataFrame:
    """Items that name an order and a product."""
    return items.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())


def item_keys(items: DataFrame) -> DataFrame:
    """The fact's natural key as the items have it, matched or not.

    A number that cannot be read is NULL here: its row may never reach the fact.
    """
    number = numeric.whole_number_or_null(F.col("order_item_id"))
    return identified(items).select("order_id", number.alias("order_item_id"))


def items_with_keys(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items of a known product, with its key."""
    return (
        identified(items)
        .select("order_id", "order_item_id", "product_id", "price", "freight_value")
        .join(products.select("product_id", "product_key"), "product_id")
        .drop("product_id")
    )


def of_known_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(orders, "order_id")


def order_items(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    time: DataFrame,
) -> DataFrame:
    """One row per item whose order, product, customer and date all exist.

    Delivery texts are read once an order and not once an item, but one that cannot be read
    travels as text. Such texts and those of items fail only here, after the joins, so bad
    text in a row that is dropped anyway does not fail the load.
    """
    dated = orders_with_keys(orders, customers, time).select(
        *["order_id", "customer_key", "time_key", "order_status", "purchase_timestamp"],
        *_read_early("order_delivered_customer_date", "delivered"),
        *_read_early("order_estimated_delivery_date", "estimated"),
    )
    joined = of_known_orders(items_with_keys(items, products), dated)
    price = numeric.money(F.col("price"))
    freight = numeric.money(F.col("freight_value"))
    delivered, estimated = _read_or_fail("delivered"), _read_or_fail("estimated")
    purchased = F.col("purchase_timestamp")
    return joined.select(
        "order_id",
        numeric.whole_number(F.col("order_item_id")).alias("order_item_id"),
        "customer_key",
        "product_key",
        "time_key",
        price.alias("price"),
        freight.alias("freight_value"),
        numeric.money_sum(price, freight).alias("total_revenue"),
        "order_status",
        "purchase_timestamp",
        delivered.alias("delivery_timestamp"),
        estimated.cast("date").cast("timestamp_ntz").alias("estimated_delivery_date"),
        temporal.whole_days(purchased, delivered).alias("delivery_days"),
    )


def _read_early(column: str, name: str) -> tuple[Column, Column]:
    """The time a text holds, and the text if it holds none."""
    text = F.col(column)
    read = temporal.wall_clock_or_null(text)
    return read.alias(name), F.when(read.isNull(), text).alias(f"unread_{name}")


def _read_or_fail(name: str) -> Column:
    unread = F.col(f"unread_{name}")
    return F.when(unread.isNotNull(), temporal.wall_clock(unread)).otherwise(F.col(name))


def join_losses(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    time: DataFrame,
) -> DataFrame:
    """(step, kept_rows): how many items survive each join, in the order of the load."""
    per_order = identified(items).select("order_id", "product_id")
    dated = orders.select(
        "order_id",
        "customer_id",
        temporal.calendar_date(F.col("order_purchase_timestamp")).alias("full_date"),
        F.lit(True).alias("has_order"),
    )
    known_customers = customers.select("customer_id", F.lit(True).alias("has_customer"))
    known_products = products.select("product_id", F.lit(True).alias("has_product"))
    known_dates = time.select("full_date", F.lit(True).alias("has_date"))
    # Left joins on unique keys mark each item once; the steps are then plain counts.
    marked = (
        per_order.groupBy("order_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(known_products, "product_id", "left")
        .groupBy("order_id")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("has_product"), F.col("n"))).alias("n_product"),
        )
        .join(
            dated.join(known_dates, "full_date", "left").join(
                known_customers, "customer_id", "left"
            ),
            "order_id",
            "left",
        )
    )
    has_order = F.col("has_order").isNotNull()
    has_customer = has_order & F.col("has_customer").isNotNull()
    steps = {
        "items": F.sum("n"),
        "orders": F.sum(F.when(has_order, F.col("n"))),
        "products": F.sum(F.when(has_order, F.col("n_product"))),
        "customers": F.sum(F.when(has_customer, F.col("n_product"))),
        "time": F.sum(F.when(has_customer & F.col("has_date").isNotNull(), F.col("n_product"))),
    }
    counted = marked.agg(*[F.coalesce(n, F.lit(0)).alias(step) for step, n in steps.items()])
    return counted.unpivot([], list(steps), "step", "kept_rows")
