"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each entry wires the source-shaped test tables into one library operator
or model, reading whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions import columns as fn
from ..operators import quality as q
from ..operators import policies, security
from ..operators.dedup import dedup_latest
from ..session import apply_runtime_conf
from ..sources import testdata as td
from ..streaming.cdc import flatten_events
from . import marts, reports, staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            # a fresh Dataset per call: views shared across queries keep their
            # own query execution, callers get a plan made under current conf
            return fn(spark, sf_dir).select("*")
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        return wrapped
    return deco


# -- minimum slice: raw -> staging -> fact ---------------------------------
# The staging views and the fact over the test tables are defined once per
# session and directory (lazy plans; each query still runs them in full).
@td._memo
def build_stg_orders(spark, sf_dir):
    return staging.stg_orders(td.raw_orders(spark, sf_dir))


@td._memo
def build_stg_customers(spark, sf_dir):
    return staging.stg_customers(td.raw_customers(spark, sf_dir))


@td._memo
def build_fct_orders(spark, sf_dir):
    return marts.fct_orders(build_stg_orders(spark, sf_dir), build_stg_customers(spark, sf_dir))


@register("fct_orders")
def q_fct_orders(spark, sf_dir):
    return build_fct_orders(spark, sf_dir)


@register("stg_orders")
def q_stg_orders(spark, sf_dir):
    return build_stg_orders(spark, sf_dir)


@register("stg_customers")
def q_stg_customers(spark, sf_dir):
    return build_stg_customers(spark, sf_dir)


def source_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "customers": td.source_customers(spark, sf_dir),
        "products": td.source_products(spark, sf_dir),
        "orders": td.source_orders(spark, sf_dir),
        "order_items": td.source_order_items(spark, sf_dir),
        "payments": td.source_payments(spark, sf_dir),
    }


# -- dedup on a natural duplicate set ----------------------------------------
@register("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    """Latest lineitem per (l_orderkey, l_linenumber) by ship date, ties
    broken by part then supplier key."""
    li = td.read(spark, sf_dir, "lineitem")
    return dedup_latest(li, ["l_orderkey", "l_linenumber"],
                        [F.col("l_shipdate").desc_nulls_first(), F.col("l_partkey").asc(),
                         F.col("l_suppkey").asc()])


@register("fct_orders_daily")
def q_fct_orders_daily(spark, sf_dir):
    return marts.fct_orders_daily(build_fct_orders(spark, sf_dir))


# -- verification / reporting ------------------------------------------------
@register("row_counts")
def q_row_counts(spark, sf_dir):
    return reports.row_counts(source_tables(spark, sf_dir))


@register("orders_by_status")
def q_orders_by_status(spark, sf_dir):
    return reports.orders_by_status(td.source_orders(spark, sf_dir))


@register("revenue_by_customer")
def q_revenue_by_customer(spark, sf_dir):
    return reports.revenue_by_customer(td.source_customers(spark, sf_dir),
                                       td.source_orders(spark, sf_dir))


@register("latest_update")
def q_latest_update(spark, sf_dir):
    t = source_tables(spark, sf_dir)
    return reports.latest_update({k: t[k] for k in ("customers", "products", "orders", "payments")})


@register("watermark_simulation")
def q_watermark_simulation(spark, sf_dir):
    return reports.changed_since({"orders": td.source_orders(spark, sf_dir),
                                  "customers": td.source_customers(spark, sf_dir)},
                                 td.CHANGED_SINCE_AS_OF)


def order_orphans(t: dict[str, DataFrame]) -> DataFrame:
    return reports.fk_orphans({
        "orphaned_items": (t["order_items"], "order_id", t["orders"], "order_id"),
        "orphaned_payments": (t["payments"], "order_id", t["orders"], "order_id"),
    })


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    return order_orphans(source_tables(spark, sf_dir))


@register("three_way_join")
def q_three_way_join(spark, sf_dir):
    return reports.order_lines_detail(td.source_order_items(spark, sf_dir),
                                      td.source_orders(spark, sf_dir),
                                      td.source_products(spark, sf_dir))


@register("line_total")
def q_line_total(spark, sf_dir):
    return td.source_order_items(spark, sf_dir)


# -- data quality --------------------------------------------------------------
def fct_checks(fct: DataFrame) -> q.TableChecks:
    return q.TableChecks(
        "fct_orders", fct,
        row_checks=[q.expression_is_true("expression_order_total_usd_ge_0", "order_total_usd >= 0"),
                    q.not_null("order_id"), q.not_null("customer_id"),
                    q.not_null("order_total_usd"), q.not_null("created_at")],
        unique=[["order_id"]], failure_key=F.col("order_id"))


def raw_orders_checks(raw: DataFrame, severity: str = "error") -> q.TableChecks:
    return q.TableChecks(
        "raw.orders", raw,
        row_checks=[q.not_null(c, severity) for c in ("order_id", "customer_id", "order_total")],
        unique=[["order_id"]], failure_key=F.col("order_ref"), severity=severity)


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    raw = td.raw_orders(spark, sf_dir)
    fct = build_fct_orders(spark, sf_dir)
    return q.row_check_counts(raw, "raw.orders", [q.not_null(c) for c in
                                                  ("order_id", "customer_id", "order_total")]) \
        .unionByName(q.row_check_counts(fct, "fct_orders", [q.not_null(c) for c in (
            "order_id", "customer_id", "order_total_usd", "created_at")]))


@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    return (q.unique_failures(td.raw_orders(spark, sf_dir), "raw.orders", ["order_id"])
            .unionByName(q.unique_failures(build_fct_orders(spark, sf_dir), "fct_orders", ["order_id"]))
            .unionByName(q.unique_failures(td.read(spark, sf_dir, "lineitem"), "lineitem",
                                           ["l_orderkey", "l_linenumber"])))


def expression_checks(fct: DataFrame, stg_orders: DataFrame, items: DataFrame) -> DataFrame:
    return (q.row_check_counts(fct, "fct_orders",
                               [q.expression_is_true("expression_order_total_usd_ge_0",
                                                     "order_total_usd >= 0")])
            .unionByName(q.row_check_counts(stg_orders, "stg_orders",
                                            [q.expression_is_true("expression_updated_after_created",
                                                                  "updated_at >= created_at")]))
            .unionByName(q.row_check_counts(items, "order_items",
                                            [q.expression_is_true("expression_line_total_le_gross",
                                                                  "line_total <= quantity * unit_price")])))


@register("dq_expression")
def q_dq_expression(spark, sf_dir):
    return expression_checks(build_fct_orders(spark, sf_dir), build_stg_orders(spark, sf_dir),
                             td.source_order_items(spark, sf_dir))


def not_positive(fct: DataFrame) -> DataFrame:
    """Singular test: rows returned are failures."""
    return fct.where(F.col("order_total_usd") <= 0).select("order_id")


@register("dq_positive_total")
def q_dq_positive_total(spark, sf_dir):
    return not_positive(build_fct_orders(spark, sf_dir))


# The source tables' CHECK constraints and accepted-value lists.
CHECK_CONSTRAINTS = {
    "products": [("products_price_check", "unit_price >= 0"),
                 ("products_cost_check", "cost_price IS NULL OR cost_price >= 0")],
    "orders": [("orders_total_check", "order_total >= 0"),
               ("orders_tax_check", "tax_amount >= 0"),
               ("orders_discount_check", "discount_amount >= 0")],
    "order_items": [("order_items_qty_check", "quantity > 0"),
                    ("order_items_price_check", "unit_price >= 0"),
                    ("order_items_disc_check", "discount_pct BETWEEN 0 AND 100")],
    "payments": [("payments_amount_check", "amount > 0")],
}

ACCEPTED_VALUES = {
    "customers": [("segment", ("enterprise", "smb", "consumer"))],
    "orders": [("status", ("pending", "confirmed", "processing", "shipped", "delivered",
                           "cancelled", "refunded"))],
    "payments": [("payment_method", ("card", "bank_transfer", "wallet", "cash")),
                 ("status", ("pending", "authorised", "captured", "failed", "refunded", "disputed"))],
}


def constraint_counts(t: dict[str, DataFrame]) -> DataFrame:
    parts = [q.row_check_counts(t[name], name, [q.expression_is_true(n, e) for n, e in rules])
             for name, rules in CHECK_CONSTRAINTS.items()]
    return reports._union(parts)


@register("dq_check_constraints")
def q_dq_check_constraints(spark, sf_dir):
    return constraint_counts(source_tables(spark, sf_dir))


def accepted_counts(t: dict[str, DataFrame]) -> DataFrame:
    parts = [q.row_check_counts(t[name], name, [q.accepted_values(c, vals) for c, vals in rules])
             for name, rules in ACCEPTED_VALUES.items()]
    return reports._union(parts)


@register("dq_accepted_values")
def q_dq_accepted_values(spark, sf_dir):
    return accepted_counts(source_tables(spark, sf_dir))


def relationship_specs(t: dict[str, DataFrame]):
    return [("orders", "customer_id", "customers", "customer_id"),
            ("order_items", "order_id", "orders", "order_id"),
            ("order_items", "product_id", "products", "product_id"),
            ("payments", "order_id", "orders", "order_id")]


def relationship_counts(t: dict[str, DataFrame]) -> DataFrame:
    """Foreign keys of every table; one pass per child table."""
    by_child: dict[str, list] = {}
    for child, fk, parent, pk in relationship_specs(t):
        by_child.setdefault(child, []).append((fk, t[parent], parent, pk))
    return reports._union([q.relationship_counts(t[child], child, rels) for child, rels in by_child.items()])


@register("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    return relationship_counts(source_tables(spark, sf_dir))


# The same checks over tables with broken rows: every one of them fails.
def faulty_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: td.faulty(df, name) if name in td.FAULTS else df
            for name, df in source_tables(spark, sf_dir).items()}


@register("fk_orphans_failing")
def q_fk_orphans_failing(spark, sf_dir):
    return order_orphans(faulty_tables(spark, sf_dir))


@register("dq_check_constraints_failing")
def q_dq_check_constraints_failing(spark, sf_dir):
    return constraint_counts(faulty_tables(spark, sf_dir))


@register("dq_accepted_values_failing")
def q_dq_accepted_values_failing(spark, sf_dir):
    return accepted_counts(faulty_tables(spark, sf_dir))


@register("dq_relationships_failing")
def q_dq_relationships_failing(spark, sf_dir):
    return relationship_counts(faulty_tables(spark, sf_dir))


@register("dq_expression_failing")
def q_dq_expression_failing(spark, sf_dir):
    return expression_checks(td.faulty(build_fct_orders(spark, sf_dir), "fct_orders"),
                             td.faulty(build_stg_orders(spark, sf_dir), "stg_orders"),
                             td.faulty(td.source_order_items(spark, sf_dir), "order_items"))


@register("dq_positive_total_failing")
def q_dq_positive_total_failing(spark, sf_dir):
    return not_positive(td.faulty(build_fct_orders(spark, sf_dir), "fct_orders"))


@register("dq_suite_summary")
def q_dq_suite_summary(spark, sf_dir):
    """Test suite: source tests on raw orders (warn: the raw
    layer holds several versions by design) and model tests on the fact."""
    raw = raw_orders_checks(td.raw_orders(spark, sf_dir), severity="warn")
    return q.suite_summary([raw, fct_checks(build_fct_orders(spark, sf_dir))])


@register("source_freshness")
def q_source_freshness(spark, sf_dir):
    return q.source_freshness({"orders": td.raw_orders(spark, sf_dir),
                               "customers": td.raw_customers(spark, sf_dir),
                               "products": td.raw_products(spark, sf_dir)},
                              "_extracted_at", td.AS_OF)


# -- documented marts ----------------------------------------------------------
@register("int_orders_enriched")
def q_int_orders_enriched(spark, sf_dir):
    return marts.int_orders_enriched(build_stg_orders(spark, sf_dir), build_stg_customers(spark, sf_dir))


@register("customer_lifetime_value")
def q_customer_lifetime_value(spark, sf_dir):
    return marts.customer_lifetime_value(td.raw_orders(spark, sf_dir))


@register("dim_customers")
def q_dim_customers(spark, sf_dir):
    return marts.dim_customers(build_stg_customers(spark, sf_dir))


@register("dim_products")
def q_dim_products(spark, sf_dir):
    return marts.dim_products(td.raw_products(spark, sf_dir))


# -- functions -------------------------------------------------------------
@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    raw = td.raw_orders(spark, sf_dir)
    return raw.select("order_ref", "ver", fn.surrogate_key("order_id", "ver").alias("order_sk"))


@register("safe_divide")
def q_safe_divide(spark, sf_dir):
    li = td.read(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     fn.safe_divide("l_tax", "l_discount").alias("tax_per_discount"))


@register("cast_uuid")
def q_cast_uuid(spark, sf_dir):
    raw = td.raw_customers(spark, sf_dir)
    v = fn.cast_uuid("external_id", strict=False)
    return raw.select("customer_id", "ver", F.col("external_id").alias("external_id_raw"),
                      v.alias("external_id"), v.isNotNull().alias("is_valid"))


@register("mask_pii")
def q_mask_pii(spark, sf_dir):
    c = td.source_customers(spark, sf_dir)
    return c.select("customer_id", fn.sha256("full_name").alias("full_name_hash"),
                    fn.mask_email("email").alias("email_masked"),
                    fn.mask_digits("phone").alias("phone_masked"), "country_code")


@register("row_level_filter")
def q_row_level_filter(spark, sf_dir):
    ent = security.region_entitlements(td.read(spark, sf_dir, "nation"), td.read(spark, sf_dir, "region"))
    return security.row_level_filter(td.source_customers(spark, sf_dir), ent, "reader_role",
                                     "europe_analyst", "country_code")


@register("policy_analyst")
def q_policy_analyst(spark, sf_dir):
    """Customers as the analysts of one region see them."""
    return policies.as_role(td.source_customers(spark, sf_dir), "customers", td.reader_policies(spark, sf_dir),
                            "asia_analyst")


@register("policy_support")
def q_policy_support(spark, sf_dir):
    return policies.as_role(td.source_customers(spark, sf_dir), "customers", td.reader_policies(spark, sf_dir),
                            "support")


@register("flatten_events_json")
def q_flatten_events_json(spark, sf_dir):
    return flatten_events(td.read(spark, sf_dir, "events"))
