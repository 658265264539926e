"""Golden values on the small seed data set: the rows are inserted with
the library's DML operators (VALUES joined on natural keys, identity
keys, ON CONFLICT DO NOTHING, UPDATE with an updated_at trigger), then
the verification queries and the fact are checked against known results."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import seed_fixture as S
from ledgerline.operators import quality, tables
from ledgerline.plans import marts, reports, staging
from ledgerline.sources.extract import SourceSpec, extract_full

CLOCK = dt.datetime(2024, 6, 1, 12, 0, 0)


def _ago(days):
    return CLOCK - dt.timedelta(days=days)


@pytest.fixture(scope="module")
def seed(spark, tmp_path_factory):
    from ledgerline.session import scratch_path

    # customers: identity ids in insertion order; ON CONFLICT (email) DO NOTHING
    cust_path = scratch_path(spark, "seed_customers")
    empty = spark.createDataFrame([], "customer_id bigint, email string, full_name string, segment string, "
                                      "country_code string, is_active boolean, created_at timestamp_ntz, "
                                      "updated_at timestamp_ntz")
    tables.write_table(empty, cust_path)
    cust_rows = spark.createDataFrame(
        [(i, e, n, s, c, a, _ago(cd), _ago(ud)) for i, (e, n, s, c, a, cd, ud) in enumerate(S.CUSTOMERS)],
        "_ord int, email string, full_name string, segment string, country_code string, is_active boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz")
    new_c = tables.assign_identity(cust_rows, "customer_id", 0, ["_ord"]).drop("_ord")
    tables.insert_ignore_table(spark, cust_path, new_c, ["email"], [F.col("customer_id").asc()])
    # running the same insert again changes nothing
    tables.insert_ignore_table(spark, cust_path, new_c, ["email"], [F.col("customer_id").asc()])

    prod = tables.assign_identity(
        spark.createDataFrame([(i, sku, n, c, p) for i, (sku, n, c, p) in enumerate(S.PRODUCTS)],
                              "_ord int, sku string, name string, category string, unit_price string")
        .withColumn("unit_price", F.col("unit_price").cast("decimal(18,4)")),
        "product_id", 0, ["_ord"]).drop("_ord").withColumn("updated_at", F.lit(_ago(30)))

    customers = spark.read.parquet(cust_path)
    o_vals = spark.createDataFrame(
        [(i, r, e, s, t, x, _ago(cd), _ago(ud)) for i, (r, e, s, t, x, cd, ud) in enumerate(S.ORDERS)],
        "_ord int, order_ref string, email string, status string, order_total string, tax_amount string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz")
    orders = tables.assign_identity(
        o_vals.join(customers.select("email", "customer_id"), "email")   # natural key -> surrogate id
              .withColumn("order_total", F.col("order_total").cast("decimal(18,2)"))
              .withColumn("tax_amount", F.col("tax_amount").cast("decimal(18,2)")),
        "order_id", 0, ["_ord"]).drop("_ord", "email")

    i_vals = spark.createDataFrame(S.ORDER_ITEMS, "order_ref string, sku string, quantity int, discount_pct int") \
        .withColumn("discount_pct", F.col("discount_pct").cast("decimal(5,2)"))
    items = (i_vals.join(orders.select("order_ref", "order_id", "created_at"), "order_ref")
                   .join(prod.select("sku", "product_id", "unit_price"), "sku")
                   .select("order_id", "product_id", "quantity", "unit_price", "discount_pct",
                           F.round(F.col("quantity") * F.col("unit_price")
                                   * (F.lit(1) - F.col("discount_pct") / F.lit(100)), 2)
                            .cast("decimal(18,2)").alias("line_total"), "created_at"))

    payments = (spark.createDataFrame(S.PAYMENTS, "order_ref string, payment_method string, status string")
                .join(orders.select("order_ref", "order_id", F.col("order_total").alias("amount"), "updated_at"),
                      "order_ref"))

    # updates (the trigger stamps updated_at)
    touch = F.lit(CLOCK).cast("timestamp_ntz")
    for ref, st in S.ORDER_STATUS_UPDATES:
        orders = tables.update_where(orders, F.col("order_ref") == ref, {"status": st}, touch=("updated_at", touch))
    customers = spark.read.parquet(cust_path)
    for email, seg in S.CUSTOMER_SEGMENT_UPDATES:
        customers = tables.update_where(customers, F.col("email") == email, {"segment": seg},
                                        touch=("updated_at", touch))
    for sku, price in S.PRODUCT_PRICE_UPDATES:
        prod = tables.update_where(prod, F.col("sku") == sku, {"unit_price": F.lit(price)},
                                   touch=("updated_at", touch))
    return {"customers": customers.cache(), "products": prod.cache(), "orders": orders.cache(),
            "order_items": items.cache(), "payments": payments.cache()}


def test_row_counts(seed):
    got = {r.tbl: r.rows for r in reports.row_counts(seed).collect()}
    assert got == {"customers": 10, "products": 15, "orders": 25, "order_items": 34, "payments": 28}


def test_orders_by_status(seed):
    got = {r.status: (r.order_count, r.total_revenue) for r in reports.orders_by_status(seed["orders"]).collect()}
    assert got == {
        "delivered": (12, Decimal("33648.92")), "shipped": (4, Decimal("6948.97")),
        "processing": (3, Decimal("3748.99")), "cancelled": (2, Decimal("2849.99")),
        "confirmed": (2, Decimal("2399.99")), "pending": (1, Decimal("199.99")),
        "refunded": (1, Decimal("699.99"))}


def test_revenue_by_customer(seed):
    got = {r.full_name: (r.orders, r.lifetime_value)
           for r in reports.revenue_by_customer(seed["customers"], seed["orders"]).collect()}
    assert got == {
        "Grace Kim": (3, Decimal("10599.99")), "Alice Johnson": (3, Decimal("10299.98")),
        "Carol White": (3, Decimal("7699.98")), "Henry Zhang": (3, Decimal("5998.98")),
        "Bob Smith": (3, Decimal("4349.99")), "Emma Brown": (1, Decimal("4299.99")),
        "David Lee": (3, Decimal("1449.96")), "Isabella Rossi": (2, Decimal("1348.99")),
        "Frank Garcia": (1, Decimal("899.00"))}


def test_fact_totals_and_tests(seed):
    raw_o = extract_full(seed["orders"], SourceSpec("orders"), extracted_at=CLOCK)
    raw_c = extract_full(seed["customers"].withColumn("external_id", F.expr("uuid()"))
                         .withColumn("phone", F.lit(None).cast("string"))
                         .withColumn("city", F.lit(None).cast("string")), SourceSpec("customers"),
                         extracted_at=CLOCK)
    fct = marts.fct_orders(staging.stg_orders(raw_o), staging.stg_customers(raw_c))
    t = fct.agg(F.count("*").alias("n"), F.sum("order_total_usd").alias("total"),
                F.sum("tax_amount_usd").alias("tax"), F.sum("net_revenue_usd").alias("net")).first()
    assert (t.n, t.total, t.tax, t.net) == (25, Decimal("50496.84"), Decimal("4931.24"), Decimal("45565.60"))
    assert fct.where("order_total_usd <= 0").count() == 0
    summary = quality.suite_summary([quality.TableChecks(
        "fct_orders", fct, row_checks=[quality.expression_is_true("ge0", "order_total_usd >= 0"),
                                       quality.not_null("order_id"), quality.not_null("customer_id"),
                                       quality.not_null("order_total_usd"), quality.not_null("created_at")],
        unique=[["order_id"]])])
    quality.gate(summary)


def test_orphans_and_line_totals(seed):
    got = {r.check_name: r.violations for r in reports.fk_orphans({
        "orphaned_items": (seed["order_items"], "order_id", seed["orders"], "order_id"),
        "orphaned_payments": (seed["payments"], "order_id", seed["orders"], "order_id")}).collect()}
    assert got == {"orphaned_items": 0, "orphaned_payments": 0}
    assert seed["order_items"].agg(F.sum("line_total")).first()[0] == Decimal("50741.39")


def test_payments_by_status(seed):
    got = {r.status: (r["count"], r.amount) for r in seed["payments"].groupBy("status")
           .agg(F.count("*").alias("count"), F.sum("amount").alias("amount")).collect()}
    assert got == {"captured": (16, Decimal("42497.88")), "authorised": (5, Decimal("8548.99")),
                   "refunded": (3, Decimal("3549.98")), "pending": (2, Decimal("1399.98")),
                   "failed": (1, Decimal("999.00")), "disputed": (1, Decimal("4299.99"))}


def test_segment_change_is_tracked(seed):
    from ledgerline.operators import history
    before = seed["customers"].withColumn("segment", F.when(F.col("email") == "bob.smith@techwave.io", "smb")
                                          .otherwise(F.col("segment"))).withColumn(
        "updated_at", F.when(F.col("email") == "bob.smith@techwave.io", F.lit(_ago(5)))
        .otherwise(F.col("updated_at")))
    versions = before.unionByName(seed["customers"]).distinct()
    h = history.scd2_check(versions, ["customer_id"], "updated_at", ["segment"])
    bob = h.join(seed["customers"].where("email = 'bob.smith@techwave.io'").select("customer_id"), "customer_id")
    rows = sorted((r.segment, r.is_current) for r in bob.collect())
    assert rows == [("enterprise", True), ("smb", False)]
