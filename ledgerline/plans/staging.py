"""Staging models: typed, renamed, latest version per key.

Each model is a function from raw DataFrames to a DataFrame (a view in
the lake's terms). The key filter is applied before the window so it
reaches the parquet scan; casts that can fail (uuid) run after the dedup
so only surviving rows are checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cast_uuid, char, nulls_first_desc, varchar
from ..operators.dedup import dedup_latest

def tie_break():
    """Tie-break after updated_at DESC: the later extract wins."""
    return [F.col("_extracted_at").desc_nulls_last()]


def latest_orders(raw_orders: DataFrame) -> DataFrame:
    """Latest raw version per order id, all raw columns kept."""
    src = raw_orders.where(F.col("order_id").isNotNull())
    return dedup_latest(src, ["order_id"], [nulls_first_desc("updated_at"), *tie_break()],
                        keep_row_num="_row_num")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return latest_orders(raw_orders).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_total").cast("decimal(18,2)").alias("order_total_usd"),
        F.col("tax_amount").cast("decimal(18,2)").alias("tax_amount_usd"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("_extracted_at").cast("timestamp_ntz").alias("_extracted_at"),
        F.col("_row_num"),
    )


def latest_customers(raw_customers: DataFrame) -> DataFrame:
    src = raw_customers.where(F.col("customer_id").isNotNull())
    return dedup_latest(src, ["customer_id"], [nulls_first_desc("updated_at"), *tie_break()],
                        keep_row_num="_row_num")


def stg_customers(raw_customers: DataFrame, strict_uuid: bool = True) -> DataFrame:
    return latest_customers(raw_customers).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        cast_uuid("external_id", strict=strict_uuid).alias("external_id"),
        varchar("email", 255).alias("email"),
        varchar("full_name", 255).alias("full_name"),
        varchar("phone", 50).alias("phone"),
        varchar("segment", 50).alias("segment"),
        char("country_code", 2).alias("country_code"),
        varchar("city", 100).alias("city"),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("_row_num"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    src = raw_products.where(F.col("product_id").isNotNull())
    latest = dedup_latest(src, ["product_id"], [nulls_first_desc("updated_at"), *tie_break()],
                          keep_row_num="_row_num")
    return latest.select(
        F.col("product_id").cast("string").alias("product_id"),
        varchar("sku", 100).alias("sku"),
        varchar("name", 255).alias("name"),
        varchar("category", 100).alias("category"),
        varchar("sub_category", 100).alias("sub_category"),
        F.col("unit_price").cast("decimal(18,4)").alias("unit_price"),
        F.col("cost_price").cast("decimal(18,4)").alias("cost_price"),
        char("currency", 3).alias("currency"),
        F.col("is_active").cast("boolean").alias("is_active"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        F.col("_row_num"),
    )
