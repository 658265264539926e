"""Column expressions used by the models (built-in Spark functions only,
so they stay inside whole-stage codegen)."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SURROGATE_NULL = "__null__"  # stands in for NULL inside surrogate keys
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def bound_literal(value: Any) -> Column:
    """Literal of a watermark or cursor. A naive datetime read from a
    zone-less column goes back as that same wall-clock value: ``F.lit`` alone
    would shift it by the driver's own time zone."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def varchar(c: str | Column, n: int) -> Column:
    """``x::varchar(n)`` with Postgres semantics: an explicit cast truncates.
    (Spark's CAST(x AS VARCHAR(n)) does not.)"""
    return F.substring(col_(c).cast("string"), 1, n)


def char(c: str | Column, n: int) -> Column:
    """``x::char(n)``: truncate, then blank-pad to n."""
    return F.rpad(F.substring(col_(c).cast("string"), 1, n), n, " ")


def cast_uuid(c: str | Column, strict: bool = True) -> Column:
    """``x::uuid``: 8-4-4-4-12 hex, normalised to lower case.

    strict: a malformed value raises (Postgres behaviour);
    lenient: it becomes NULL.
    """
    v = F.lower(F.trim(col_(c).cast("string")))
    ok = v.rlike(UUID_PATTERN)
    bad = F.raise_error(F.concat(F.lit("invalid uuid: "), col_(c).cast("string"))).cast("string") \
        if strict else F.lit(None).cast("string")
    return F.when(col_(c).isNull(), F.lit(None).cast("string")).when(ok, v).otherwise(bad)


def month_start(c: str | Column) -> Column:
    """``date_trunc('month', ts)`` keeping a zone-less timestamp."""
    return F.date_trunc("month", col_(c)).cast("timestamp_ntz")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the columns cast to string, NULL replaced by a sentinel,
    joined with '-'. Stable across engines for strings and integers."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """NULL when the divisor is 0 or NULL. Decimals are divided as decimals,
    anything else as doubles."""
    return F.try_divide(col_(num), col_(den))


def line_total(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """quantity * unit_price * (1 - discount), in decimals, to cents;
    ``discount`` is a fraction (a discount_pct of 5 is 0.05)."""
    return F.round(quantity * unit_price * (F.lit(1) - discount), 2).cast("decimal(18,2)")


def sha256(c: str | Column) -> Column:
    return F.sha2(col_(c).cast("string"), 256)


def mask_digits(c: str | Column, mask: str = "#") -> Column:
    return F.regexp_replace(col_(c), r"[0-9]", mask)


def mask_email(c: str | Column) -> Column:
    """Keep the first character of the local part and the domain."""
    return F.regexp_replace(col_(c), r"^(.)[^@]*", "$1***")


def nulls_first_desc(c: str | Column) -> Column:
    """``ORDER BY c DESC`` as Postgres orders it (NULLs first)."""
    return col_(c).desc_nulls_first()


def random_uuid() -> Column:
    """``gen_random_uuid()`` default: a fresh v4 uuid per row."""
    return F.expr("uuid()")


def uuid_from_key(*cols: str | Column) -> Column:
    """Deterministic uuid-shaped text from key columns (stable on retries,
    unlike ``random_uuid``): md5 of the surrogate-key text, 8-4-4-4-12."""
    h = surrogate_key(*cols)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def iso_timestamp(c: str | Column) -> Column:
    """Timestamp as ISO-8601 text (watermark values kept as text)."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def current_timestamp_utc() -> Column:
    """Current time as a zone-less UTC wall-clock value."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
