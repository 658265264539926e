"""Verification / reporting queries over the source tables: row counts,
orders by status, revenue by customer, latest update per table, the
extract preview since a point in time, FK orphan counts, the three-way
order-line join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import orphan_keys
from ..operators.skew import split_join
from .marts import EXCLUDED_FROM_REVENUE


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Labelled COUNT(*) per table, UNION ALL. Each count is a global
    aggregate with per-task partial counts."""
    return _union([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
                   for name, df in tables.items()]).orderBy("tbl")


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.round(F.sum("order_total"), 2).cast("decimal(38,2)").alias("total_revenue")) \
        .orderBy(F.desc("order_count"), "status")


def revenue_by_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers JOIN orders (status not cancelled/refunded), grouped by
    (full_name, segment): COUNT(DISTINCT order_id), ROUND(SUM(total), 2).

    Orders are aggregated per customer *before* the join (customer_id is
    the customers' primary key, and an order belongs to one customer, so
    per-customer distinct counts add up to the distinct count of the
    group). The join then sees one row per customer instead of every
    order, and a customer owning a third of all orders is combined
    map-side instead of landing in one join task.
    """
    per_customer = (orders.where(~F.col("status").isin(*EXCLUDED_FROM_REVENUE))
                          .groupBy("customer_id")
                          .agg(F.countDistinct("order_id").alias("_n"),
                               F.sum("order_total").alias("_v")))
    joined = customers.select("customer_id", "full_name", "segment").join(per_customer, "customer_id")
    return joined.groupBy("full_name", "segment").agg(
        F.sum("_n").cast("bigint").alias("orders"),
        F.round(F.sum("_v"), 2).cast("decimal(38,2)").alias("lifetime_value")) \
        .orderBy(F.desc("lifetime_value"), "full_name", "segment")


def latest_update(tables: dict[str, DataFrame]) -> DataFrame:
    """MAX(updated_at) per table label. Written as a union of per-table
    aggregates (the same result as aggregating the union) so each table is
    reduced to one row before anything is combined."""
    return _union([df.agg(F.max("updated_at").alias("latest_update"))
                     .select(F.lit(name).alias("table_name"), "latest_update")
                   for name, df in tables.items()]).orderBy("table_name")


def changed_since(tables: dict[str, DataFrame], as_of: str, lookback: str = "1 day") -> DataFrame:
    """What an incremental extract would pull: rows with updated_at >
    as_of - lookback, per table: count, min and max (0/NULL/NULL when
    nothing qualifies). The bound is a literal, so it reaches the scan."""
    bound = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {lookback}")
    return _union([df.where(F.col("updated_at") > bound)
                     .agg(F.count(F.lit(1)).alias("rows_since_yesterday"),
                          F.min("updated_at").alias("min_wm"),
                          F.max("updated_at").alias("max_wm"))
                     .select(F.lit(name).alias("tbl"), "rows_since_yesterday", "min_wm", "max_wm")
                   for name, df in tables.items()])


def fk_orphans(checks: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """check_name -> (child, fk, parent, pk): number of child rows whose
    key has no parent row; a NULL key has none."""
    return _union([
        orphan_keys(child, fk, parent, pk, count_null=True)
        .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("violations"))
        .select(F.lit(name).alias("check_name"), "violations")
        for name, (child, fk, parent, pk) in checks.items()])


def order_lines_detail(items: DataFrame, orders: DataFrame, products: DataFrame,
                       hot_rows: int | None = None) -> DataFrame:
    """items JOIN orders JOIN products. Both joins are many-to-one on the
    parent key; AQE chooses broadcast or sort-merge from runtime sizes
    and splits skewed partitions. Products are joined first: the items are
    already hash-partitioned by product key (their price lookup), so that
    join reuses the exchange and the lines are shuffled once more, by
    order id, instead of twice.

    With ``hot_rows``, products and orders with that many lines are measured
    and dealt to several tasks (``operators/skew.py``), whatever AQE sees."""
    o = orders.select("order_id", "customer_id", "status")
    p = products.select("product_id", F.col("name").alias("product_name"), "category")
    if hot_rows is None:
        lines = items.join(p, "product_id").join(o, "order_id")
    else:
        line = F.struct("order_id", "line_number")
        lines = split_join(split_join(items, p, ["product_id"], "inner", hot_rows, row=line),
                           o, ["order_id"], "inner", hot_rows, row=line)
    return lines.select("order_id", "line_number", "product_id", "supplier_id", "customer_id",
                        "status", "product_name", "category", "quantity", "unit_price",
                        "discount_pct", "line_total")
