"""The generated test tables in the shape of the staging feeds.

The tables hold no NULLs, blanks or dangling references, so the dirt the load must cope
with is added here, by fixed rules on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom import files, session, workspace
from starloom.operators.keys import number_within
from starloom.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, SOURCES, Source

# The tables the feeds are made of.
TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

# Orders an order's lines completely; line numbers alone repeat.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")

_STAMP = "yyyy-MM-dd HH:mm:ss"
_CENTS = T.DecimalType(12, 2)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _as_source(df: DataFrame, source: Source) -> DataFrame:
    """Staging columns in order; the ones ``df`` lacks are NULL."""
    have = set(df.columns)
    none = F.lit(None).cast("string")
    return df.select(*[F.col(c) if c in have else none.alias(c) for c in source.columns])


def _by_order(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders and the ship dates of their lines.

    Both are dealt out by order first where they are large. A partition then holds the same share
    of them whatever their size, and a task counts up the orders of one partition instead of all
    that it meets in its part of a file.
    """
    placed = _table(spark, folder, "orders")
    lines = _table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    size = sum(files.total_length(spark, f"{folder}/{name}.parquet") for name in ("orders", "lineitem"))
    parts = session.partitions_for(size)
    if parts == 1:
        return placed, lines
    parts = max(parts, spark.sparkContext.defaultParallelism)
    return placed.repartition(parts, "o_orderkey"), lines.repartition(parts, "o_orderkey")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    placed, lines = _by_order(spark, folder)
    last_shipped = lines.groupBy("o_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    delivered = F.when(F.col("o_orderstatus") != "P", F.date_format("shipped", _STAMP))
    staged = (
        placed.join(last_shipped, "o_orderkey", "left")
        .select(
            _text("o_orderkey").alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.date_format(F.col("o_orderdate") + hours, _STAMP).alias("order_purchase_timestamp"),
            delivered.alias("order_delivered_customer_date"),
            F.date_format("o_orderdate", _STAMP).alias("order_estimated_delivery_date"),
        )
    )
    return _as_source(staged, ORDERS)


def _items(lines: DataFrame, item: str) -> DataFrame:
    price = F.concat(F.lit(" "), F.col("l_extendedprice").cast(_CENTS).cast("string"), F.lit(" "))
    freight = F.col("l_quantity").cast(_CENTS).cast("string")
    staged = lines.select(
        _text("l_orderkey").alias("order_id"),
        _text(item).alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.when(F.col("l_orderkey") % 97 == 0, "   ").otherwise(price).alias("price"),
        F.when(F.col("l_orderkey") % 89 != 0, freight).alias("freight_value"),
    )
    return _as_source(staged, ORDER_ITEMS)


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """Items under their line numbers, which repeat within an order."""
    return _items(_table(spark, folder, "lineitem"), "l_linenumber")


def items(spark: SparkSession, folder: str, place: str | None = None) -> DataFrame:
    """Items renumbered 1..n within their order, so the fact's grain holds.

    The numbered lines are written to ``place``, a scratch folder unless it is given. Who gives
    one can delete it once the items have been read.
    """
    lines = _table(spark, folder, "lineitem").select(
        "l_orderkey", *LINE_ORDER, "l_quantity"
    )
    place = place or workspace.scratch(spark, "order-lines")
    return _items(number_within(lines, "item", "l_orderkey", LINE_ORDER, place), "item")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    places = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    region = F.replace("r_name", F.lit(" "), F.lit("-"))
    city = F.concat(F.lit("  "), F.lower(region), F.lit(" d'"), F.lower("n_name"))
    staged = (
        _table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.lpad(_text("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
            city.alias("customer_city"),
            F.concat(F.lower(F.substring("r_name", 1, 2)), F.lit(" ")).alias("customer_state"),
        )
    )
    return _as_source(staged, CUSTOMERS)


def products(spark: SparkSession, folder: str) -> DataFrame:
    weight = F.when(F.col("p_partkey") % 13 == 0, " ").otherwise(_text("p_size"))
    staged = _table(spark, folder, "part").select(
        _text("p_partkey").alias("product_id"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("product_category_name"),
        weight.alias("product_weight_g"),
    )
    return _as_source(staged, PRODUCTS)


def staging(
    spark: SparkSession, folder: str, raw_item_ids: bool = False, place: str | None = None
) -> dict[str, DataFrame]:
    """All four feeds, by staging table name; ``place`` is that of :func:`items`."""
    frames = (
        orders(spark, folder),
        raw_items(spark, folder) if raw_item_ids else items(spark, folder, place),
        customers(spark, folder),
        products(spark, folder),
    )
    return {source.table: frame for source, frame in zip(SOURCES, frames)}


def with_unknown_parents(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every 50th customer and every 40th product under another id, so references dangle."""

    def renamed(df: DataFrame, column: str, every: int) -> DataFrame:
        other = F.concat(F.lit("other-"), F.col(column))
        hit = F.col(column).cast("bigint") % every == 0
        return df.withColumn(column, F.when(hit, other).otherwise(F.col(column)))

    found = dict(frames)
    found[CUSTOMERS.table] = renamed(frames[CUSTOMERS.table], "customer_id", 50)
    found[PRODUCTS.table] = renamed(frames[PRODUCTS.table], "product_id", 40)
    return found


def with_null_keys(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Some ids and purchase times NULL, by rules on the keys."""

    def blank(df: DataFrame, column: str, by: str, every: int) -> DataFrame:
        keep = F.col(by).cast("bigint") % every != 0
        return df.withColumn(column, F.when(keep, F.col(column)))

    found = dict(frames)
    found[ORDERS.table] = blank(
        frames[ORDERS.table], "order_purchase_timestamp", "order_id", 31
    )
    found[ORDER_ITEMS.table] = blank(
        blank(frames[ORDER_ITEMS.table], "product_id", "product_id", 47), "order_id", "order_id", 53
    )
    found[CUSTOMERS.table] = blank(frames[CUSTOMERS.table], "customer_id", "customer_id", 50)
    found[PRODUCTS.table] = blank(frames[PRODUCTS.table], "product_id", "product_id", 40)
    return found
