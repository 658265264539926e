"""Next / previous row within a key, safe for hot keys.

``lead``/``lag`` over ``PARTITION BY key`` sends every row of a key to one
task. When one key holds a large share of the table (a third of all rows
is the case we plan for) that task sorts and spills alone. Here the key
sizes are measured first (one partial + final aggregate):

* if no key exceeds ``hot_rows``, the plain window is used;
* otherwise every hot key is cut into contiguous ranges of the order
  column ("pieces") at approximate percentiles computed for the hot keys
  only. The window runs per (key, piece), so each task sorts at most about
  ``hot_rows`` rows of a key. The rows at the edges of a piece take their
  neighbour from a per-piece table (first and last row of each piece; one
  row per piece, so its own window per key is small), joined back on
  (key, piece) - the same partitioning as the window output.

The order column must be non-null and unique within a key (callers pass
distinct versions).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small

HOT_ROWS = 5_000_000
MAX_PIECES = 10_000


def neighbours(df: DataFrame, key: Sequence[str], order_col: str, lag_cols: Sequence[str] = (),
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``_next`` (the following row's ``order_col`` in the key, NULL on
    the last row), ``_is_first`` and ``_prev_<c>`` for each ``lag_cols``."""
    key = list(key)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    max_n = counts.agg(F.max("_n")).first()[0] or 0
    if max_n <= hot_rows:
        return _plain(df, key, order_col, lag_cols)
    pieces = min(MAX_PIECES, math.ceil(max_n / hot_rows))
    return _split(df, key, order_col, lag_cols, counts, hot_rows, pieces)


def _plain(df, key, order_col, lag_cols):
    w = Window.partitionBy(*key).orderBy(F.col(order_col).asc())
    out = df.withColumn("_next", F.lead(order_col).over(w)) \
            .withColumn("_is_first", F.lag(order_col).over(w).isNull())
    for c in lag_cols:
        out = out.withColumn(f"_prev_{c}", F.lag(c).over(w))
    return out


def _split(df, key, order_col, lag_cols, counts, hot_rows, pieces):
    o = F.col(order_col)
    hot = counts.where(F.col("_n") > hot_rows).select(*key)
    fracs = [i / pieces for i in range(1, pieces)]
    splits = (df.join(broadcast_if_small(hot), key, "left_semi")
                .groupBy(*key)
                .agg(F.percentile_approx(order_col, fracs, max(10_000, 4 * pieces)).alias("_splits")))
    tagged = (df.join(broadcast_if_small(splits), key, "left")
                .withColumn("_piece", F.when(F.col("_splits").isNull(), F.lit(0))
                            .otherwise(F.size(F.filter("_splits", lambda s: s <= o))))
                .drop("_splits"))
    w = Window.partitionBy(*key, "_piece").orderBy(o.asc())
    inner = tagged.withColumn("_next_in", F.lead(order_col).over(w)) \
                  .withColumn("_first_in", F.lag(order_col).over(w).isNull())
    for c in lag_cols:
        inner = inner.withColumn(f"_prev_in_{c}", F.lag(c).over(w))

    # one row per piece: its first order value and its last row's values
    bounds = tagged.groupBy(*key, "_piece").agg(
        F.min(order_col).alias("_pfirst"),
        *[F.max_by(c, o).alias(f"_plast_{c}") for c in lag_cols])
    wp = Window.partitionBy(*key).orderBy("_piece")
    bounds = bounds.withColumn("_next_piece_first", F.lead("_pfirst").over(wp)) \
                   .withColumn("_has_prev_piece", F.lag("_pfirst").over(wp).isNotNull())
    for c in lag_cols:
        bounds = bounds.withColumn(f"_prev_piece_last_{c}", F.lag(f"_plast_{c}").over(wp))
    bounds = bounds.drop("_pfirst", *[f"_plast_{c}" for c in lag_cols])

    # a NULL key is a key like others: its rows must meet their piece's bounds
    named = bounds.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*key, "_piece"])],
                          *[c for c in bounds.columns if c not in (*key, "_piece")])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*key, "_piece"])]
    j = inner.join(named, on).drop(*[f"_k{i}" for i in range(len(key) + 1)])
    out = j.withColumn("_next", F.coalesce(F.col("_next_in"), F.col("_next_piece_first"))) \
           .withColumn("_is_first", F.col("_first_in") & ~F.col("_has_prev_piece"))
    for c in lag_cols:
        out = out.withColumn(f"_prev_{c}", F.when(F.col("_first_in"), F.col(f"_prev_piece_last_{c}"))
                             .otherwise(F.col(f"_prev_in_{c}")))
    drop = ["_piece", "_next_in", "_first_in", "_next_piece_first", "_has_prev_piece",
            *[f"_prev_in_{c}" for c in lag_cols], *[f"_prev_piece_last_{c}" for c in lag_cols]]
    return out.drop(*drop)
