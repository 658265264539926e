"""Marts: the finance fact, its daily rollup and the documented
dimension / enrichment / lifetime-value models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_start, surrogate_key
from ..operators.dedup import dedup_latest
from .staging import latest_orders, tie_break

FCT_COLUMNS = ["order_id", "customer_id", "order_total_usd", "tax_amount_usd",
               "net_revenue_usd", "created_at", "order_month"]
EXCLUDED_FROM_REVENUE = ("cancelled", "refunded")


def fct_orders(stg_orders: DataFrame, stg_customers: DataFrame,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per order. LEFT JOIN customers USING (customer_id).

    The right side is reduced to its distinct join key. ``stg_customers``
    is already unique per customer_id (it is deduplicated on it), so this
    changes nothing, but it tells Catalyst the key is unique: a left
    outer join whose right side is a distinct aggregate on the join key
    and contributes no columns is removed from the plan, which saves a
    full shuffle of the orders by customer_id.
    """
    customers = stg_customers.select("customer_id").distinct()
    o = stg_orders.join(customers, "customer_id", "left")
    return o.select(
        "order_id",
        "customer_id",
        "order_total_usd",
        "tax_amount_usd",
        (F.col("order_total_usd") - F.col("tax_amount_usd")).alias("net_revenue_usd"),
        "created_at",
        month_start("created_at").alias("order_month"),
        *carry,
    )


def fct_orders_daily(fct: DataFrame) -> DataFrame:
    """Fact grouped by its cluster key ``created_at::date``."""
    return fct.groupBy(F.to_date("created_at").alias("created_date")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("order_total_usd").cast("decimal(38,2)").alias("total_usd"),
        F.sum("net_revenue_usd").cast("decimal(38,2)").alias("net_revenue_usd"),
    )


def int_orders_enriched(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Fact + customer segment, country, activity + days from creation to
    the last update. The fact rows carry updated_at from staging (no
    self-join back to the orders); one LEFT JOIN on customer_id, unique on
    the right side (AQE broadcasts it when small, splits skew otherwise)."""
    fct = fct_orders(stg_orders, stg_customers, carry=("updated_at",))
    cust = stg_customers.select("customer_id", "segment", "country_code", "is_active")
    return (fct.join(cust, "customer_id", "left")
               .select(*FCT_COLUMNS, "segment", "country_code", "is_active",
                       F.datediff(F.to_date("updated_at"), F.to_date("created_at"))
                        .cast("int").alias("days_to_last_update")))


def customer_lifetime_value(raw_orders: DataFrame) -> DataFrame:
    """Per customer over the latest order versions, cancelled and refunded
    excluded: order count, revenue, first and last order time. The group
    by customer is a partial + final hash aggregate, so a customer with a
    third of all orders is combined map-side."""
    latest = latest_orders(raw_orders).where(~F.col("status").isin(*EXCLUDED_FROM_REVENUE))
    return latest.groupBy(F.col("customer_id").cast("string").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("order_total").cast("decimal(38,2)").alias("lifetime_value_usd"),
        F.min("created_at").alias("first_order_at"),
        F.max("created_at").alias("last_order_at"),
    )


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id", "external_id", "email", "full_name", "segment", "country_code", "city",
        "is_active", "created_at", "updated_at")


def dim_products(raw_products: DataFrame) -> DataFrame:
    src = raw_products.where(F.col("product_id").isNotNull())
    latest = dedup_latest(src, ["product_id"], [F.col("updated_at").desc_nulls_first(), *tie_break()])
    return latest.select(
        surrogate_key("product_id").alias("product_sk"),
        F.col("product_id").cast("string").alias("product_id"),
        "sku", "name", "category", "sub_category", "unit_price", "cost_price",
        "is_active", "updated_at")
