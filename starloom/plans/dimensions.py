"""Staging rows to dimension rows, still without their surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions import numeric, temporal, text


def customers(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        text.title_case(F.trim("customer_city")).alias("city"),
        text.region_code(F.col("customer_state")).alias("state"),
    )


def products(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("product_id").isNotNull()).select(
        "product_id",
        text.category_label(F.col("product_category_name")).alias("category_name"),
        # Declared in the layout, filled by no feed.
        F.lit(None).cast("string").alias("category_name_en"),
        numeric.measure(F.col("product_weight_g")).alias("weight_g"),
        numeric.measure(F.col("product_length_cm")).alias("length_cm"),
        numeric.measure(F.col("product_height_cm")).alias("height_cm"),
        numeric.measure(F.col("product_width_cm")).alias("width_cm"),
    )


def purchased(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_purchase_timestamp").isNotNull())


def purchase_dates(staged_orders: DataFrame) -> DataFrame:
    """Each date an order was placed on, once; dates without orders stay out.

    Distinct on the date alone, before its attributes: they all follow from it.
    """
    day = temporal.calendar_date(F.col("order_purchase_timestamp"))
    return purchased(staged_orders).select(day.alias("full_date")).distinct()


def calendar(dates: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return dates.select(
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        temporal.month_name(day).alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        temporal.iso_weekday(day).cast("smallint").alias("day_of_week"),
        temporal.day_name(day).alias("day_name"),
        temporal.iso_weekday(day).isin(6, 7).alias("is_weekend"),
    )
