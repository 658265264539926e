"""Typed schemas of the source tables, table DDL, and schema drift.

The raw layer keeps the source columns plus ``_extracted_at``. Loads are
checked against the declared schema; differences are reported, never
silently re-typed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TS = T.TimestampNTZType()


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Column names, types and nullability of the source tables.
CUSTOMERS = _s(
    ("customer_id", T.LongType(), False), ("external_id", T.StringType(), False),
    ("email", T.StringType(), False), ("full_name", T.StringType(), False),
    ("phone", T.StringType(), True), ("segment", T.StringType(), True),
    ("country_code", T.StringType(), True), ("city", T.StringType(), True),
    ("is_active", T.BooleanType(), False), ("created_at", TS, False), ("updated_at", TS, False))

PRODUCTS = _s(
    ("product_id", T.LongType(), False), ("sku", T.StringType(), False), ("name", T.StringType(), False),
    ("description", T.StringType(), True), ("category", T.StringType(), True),
    ("sub_category", T.StringType(), True), ("unit_price", T.DecimalType(18, 4), False),
    ("cost_price", T.DecimalType(18, 4), True), ("currency", T.StringType(), False),
    ("weight_kg", T.DecimalType(8, 3), True), ("is_active", T.BooleanType(), False),
    ("created_at", TS, False), ("updated_at", TS, False))

ORDERS = _s(
    ("order_id", T.LongType(), False), ("order_ref", T.StringType(), False),
    ("customer_id", T.LongType(), False), ("status", T.StringType(), False),
    ("order_total", T.DecimalType(18, 2), False), ("tax_amount", T.DecimalType(18, 2), False),
    ("discount_amount", T.DecimalType(18, 2), False), ("shipping_amount", T.DecimalType(18, 2), False),
    ("currency", T.StringType(), False), ("shipping_country", T.StringType(), True),
    ("notes", T.StringType(), True), ("placed_at", TS, True), ("shipped_at", TS, True),
    ("delivered_at", TS, True), ("cancelled_at", TS, True), ("created_at", TS, False),
    ("updated_at", TS, False))

ORDER_ITEMS = _s(
    ("item_id", T.LongType(), False), ("order_id", T.LongType(), False),
    ("product_id", T.LongType(), False), ("quantity", T.IntegerType(), False),
    ("unit_price", T.DecimalType(18, 4), False), ("discount_pct", T.DecimalType(5, 2), False),
    ("line_total", T.DecimalType(18, 2), False), ("created_at", TS, False))

PAYMENTS = _s(
    ("payment_id", T.LongType(), False), ("order_id", T.LongType(), False),
    ("payment_method", T.StringType(), False), ("payment_provider", T.StringType(), True),
    ("provider_ref", T.StringType(), True), ("amount", T.DecimalType(18, 2), False),
    ("currency", T.StringType(), False), ("status", T.StringType(), False),
    ("failure_reason", T.StringType(), True), ("captured_at", TS, True), ("refunded_at", TS, True),
    ("created_at", TS, False), ("updated_at", TS, False))

SOURCE_SCHEMAS = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS,
                  "order_items": ORDER_ITEMS, "payments": PAYMENTS}


def raw_schema(source: T.StructType) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType, True) for f in source.fields],
                         T.StructField("_extracted_at", TS, True)])


def create_table_if_not_exists(spark: SparkSession, name: str, schema: T.StructType, path: str,
                               comment: str | None = None,
                               column_comments: dict[str, str] | None = None) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION path`` with
    column comments kept in the schema."""
    cc = column_comments or {}
    sch = T.StructType([T.StructField(f.name, f.dataType, f.nullable,
                                      {"comment": cc[f.name]} if f.name in cc else f.metadata)
                        for f in schema.fields])
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=sch,
                                  description=comment)
    return spark.table(name)


def schema_drift(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, change, expected type, actual type) for every column that is
    missing, unexpected, or of another type. Driver-side over the schemas
    only (no data is read)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    out = []
    for c, t in want.items():
        if c not in actual:
            out.append((c, "missing", t.simpleString(), ""))
        elif actual[c] != t:
            out.append((c, "type_changed", t.simpleString(), actual[c].simpleString()))
    for c, t in actual.items():
        if c not in want:
            out.append((c, "unexpected", "", t.simpleString()))
    return out
