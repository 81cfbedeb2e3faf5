"""A report over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def revenue_by_month_category(fact: DataFrame, products: DataFrame, time: DataFrame) -> DataFrame:
    """Items, revenue and mean delivery days per purchase month and product category.

    Items are summed per product and month before the product join, so a product that
    holds much of the fact enters it as a few rows.
    """
    per_product = (
        fact.select("product_key", "time_key", "total_revenue", "delivery_days")
        .join(time.select("time_key", "year", "month"), "time_key")
        .groupBy("product_key", "year", "month")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.sum("total_revenue").alias("revenue"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("delivered"),
        )
    )
    mean_days = F.when(F.sum("delivered") > 0, F.sum("days") / F.sum("delivered"))
    return (
        per_product.join(products.select("product_key", "category_name"), "product_key")
        .groupBy("year", "month", "category_name")
        .agg(
            F.sum("items").alias("item_count"),
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
            mean_days.cast("double").alias("avg_delivery_days"),
        )
    )
