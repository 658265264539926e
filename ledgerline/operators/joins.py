"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint only behind a runtime size check.

    ``limit(max_rows + 1).count()`` stops reading once the bound is
    exceeded, so the check is cheap even on a large table. Above the
    bound the frame is returned unhinted and AQE decides from shuffle
    statistics (sort-merge join, skew splitting).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def by_key(left: DataFrame, keys: DataFrame, key: list[str], how: str,
           small: bool = False) -> DataFrame:
    """Semi or anti join on ``key`` in which a NULL key equals a NULL key
    (still an equi-join: hash and sort-merge joins apply). ``small`` broadcasts
    the keys; the caller has checked their number."""
    right = keys.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)])
    on = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)]
    return left.join(F.broadcast(right) if small else right, on, how)
