"""Declared layouts of the staging sources and of the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from starloom.functions.numeric import MEASURE, MONEY


@dataclass(frozen=True, eq=False)
class Source:
    """One raw feed: where it lies, what it must contain, what identifies a row."""

    table: str
    pattern: str
    columns: tuple[str, ...]
    required: tuple[str, ...]
    primary_key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def qualified(self) -> str:
        return f"staging.{self.table}"


@dataclass(frozen=True, eq=False)
class Target:
    """One warehouse table. A non-nullable field is a NOT NULL rule."""

    table: str
    key: str
    natural_key: tuple[str, ...]
    fields: tuple[T.StructField, ...]
    stamped: bool = True
    max_length: dict[str, int] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        # Keys are 64-bit: the values of a 32-bit sequence, without its two-billion-row end.
        head = T.StructField(self.key, T.LongType(), False)
        tail = [T.StructField("created_at", T.TimestampNTZType())] if self.stamped else []
        return T.StructType([head, *self.fields, *tail])

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if not f.nullable)

    @property
    def qualified(self) -> str:
        return f"warehouse.{self.table}"


# Feed and column names, `lenght` included, are those of the input files.
ORDERS = Source(
    table="stg_orders",
    pattern="*orders_dataset.csv",
    columns=(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    required=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    primary_key=("order_id",),
)

ORDER_ITEMS = Source(
    table="stg_order_items",
    pattern="*order_items_dataset.csv",
    columns=(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    required=("order_id", "order_item_id", "product_id", "price"),
    primary_key=("order_id", "order_item_id"),
)

CUSTOMERS = Source(
    table="stg_customers",
    pattern="*customers_dataset.csv",
    columns=(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    required=("customer_id", "customer_unique_id"),
    primary_key=("customer_id",),
)

PRODUCTS = Source(
    table="stg_products",
    pattern="*products_dataset.csv",
    columns=(
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    required=("product_id",),
    primary_key=("product_id",),
)

SOURCES = (ORDERS, ORDER_ITEMS, CUSTOMERS, PRODUCTS)


def _col(name: str, kind: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable)


DIM_CUSTOMERS = Target(
    table="dim_customers",
    key="customer_key",
    natural_key=("customer_id",),
    fields=(
        _col("customer_id", T.StringType(), nullable=False),
        _col("customer_unique_id", T.StringType()),
        _col("zip_code_prefix", T.StringType()),
        _col("city", T.StringType()),
        _col("state", T.StringType()),
    ),
    max_length={"state": 2},
)

DIM_PRODUCTS = Target(
    table="dim_products",
    key="product_key",
    natural_key=("product_id",),
    fields=(
        _col("product_id", T.StringType(), nullable=False),
        _col("category_name", T.StringType()),
        _col("category_name_en", T.StringType()),
        _col("weight_g", MEASURE),
        _col("length_cm", MEASURE),
        _col("height_cm", MEASURE),
        _col("width_cm", MEASURE),
    ),
)

DIM_TIME = Target(
    table="dim_time",
    key="time_key",
    natural_key=("full_date",),
    fields=(
        _col("full_date", T.DateType(), nullable=False),
        _col("year", T.ShortType(), nullable=False),
        _col("quarter", T.ShortType(), nullable=False),
        _col("month", T.ShortType(), nullable=False),
        _col("month_name", T.StringType(), nullable=False),
        _col("week_of_year", T.ShortType(), nullable=False),
        _col("day_of_month", T.ShortType(), nullable=False),
        _col("day_of_week", T.ShortType(), nullable=False),
        _col("day_name", T.StringType(), nullable=False),
        _col("is_weekend", T.BooleanType(), nullable=False),
    ),
    stamped=False,
)

FACT_ORDERS = Target(
    table="fact_orders",
    key="order_item_key",
    natural_key=("order_id", "order_item_id"),
    fields=(
        _col("order_id", T.StringType(), nullable=False),
        _col("order_item_id", T.IntegerType(), nullable=False),
        _col("customer_key", T.LongType()),
        _col("product_key", T.LongType()),
        _col("time_key", T.LongType()),
        _col("price", MONEY),
        _col("freight_value", MONEY),
        _col("total_revenue", MONEY),
        _col("order_status", T.StringType()),
        _col("purchase_timestamp", T.TimestampNTZType()),
        _col("delivery_timestamp", T.TimestampNTZType()),
        _col("estimated_delivery_date", T.TimestampNTZType()),
        _col("delivery_days", T.IntegerType()),
    ),
    references={
        "customer_key": "dim_customers",
        "product_key": "dim_products",
        "time_key": "dim_time",
    },
)

DIMENSIONS = (DIM_CUSTOMERS, DIM_PRODUCTS, DIM_TIME)
TARGETS = (*DIMENSIONS, FACT_ORDERS)
