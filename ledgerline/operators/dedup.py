"""Latest version per key.

``row_number() OVER (PARTITION BY key ORDER BY ...) = 1`` is planned by
Catalyst with a partial WindowGroupLimit before the shuffle: each map task
sorts its own rows and keeps only the top row per key, so a hot key (a
third of all rows) reaches the exchange as one row per map task. The full
group is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col_


def rank_versions(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column],
                  name: str = "_row_num") -> DataFrame:
    w = Window.partitionBy(*[col_(k) for k in keys]).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def dedup_latest(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column],
                 keep_row_num: str | None = None) -> DataFrame:
    """Keep the first row per key under ``order_by`` (give a total order:
    append tie-break columns). ``keep_row_num`` keeps the rank column
    under that name (always 1), as the staging views do."""
    name = keep_row_num or "_dedup_rn"
    out = rank_versions(df, keys, order_by, name).where(F.col(name) == 1)
    return out if keep_row_num else out.drop(name)
