"""Equi-joins that spread keys with very many rows.

A shuffled join sends all rows of a key to one task. Here the heavy keys of
both sides are measured first (``approx_top_k``: one aggregate over the key
columns, a bounded sketch), and only they are treated apart, inside the same
shuffle join:

* a row of the side where key k is heavy gets one of S(k) numbers, by a hash of
  the row, S(k) = rows of k / ``hot_rows``;
* a row of the other side is repeated once for each of the S(k) numbers;
* the join is on (key, number), so k's rows meet in S(k) tasks.

If k is heavy on both sides, an inner join deals both sides over a grid of
S(k) x T(k) numbers. Keys that are not heavy have number 0 and are joined as
ever. The measure decides the plan only: a heavy key that it misses, or two
keys that share a hash, give the same rows.

Outer joins, where rows must not be repeated on the kept side, split heavy keys
of the kept side by number, and take heavy keys of the other side as an inner
join plus the rows without a match.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000         # rows of one key that a task may take
MAX_HOT = 1_000              # heavy keys tracked per side
MAX_SPLIT = 10_000           # tasks one key is dealt to
HOWS = ("inner", "left", "left_semi", "left_anti")


def key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in on])


def heavy_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS,
               max_hot: int = MAX_HOT) -> dict[int, int]:
    """Key hash -> estimated rows, of keys with ``hot_rows`` or more. At most
    ``max_hot`` keys can have a share worth splitting; the sketch keeps ten
    times as many in sight."""
    top = (df.select(key_hash(on).alias("_h"))
           .select(F.expr(f"approx_top_k(_h, {max_hot}, {10 * max_hot})").alias("top")).first())
    return {r["item"]: r["count"] for r in top["top"] or () if r["count"] >= hot_rows}


def splits(left: dict[int, int], right: dict[int, int], hot_rows: int) -> list[tuple[int, int, int]]:
    """(key hash, S, T) of every heavy key."""
    def parts(n):
        return min(MAX_SPLIT, max(1, math.ceil(n / hot_rows)))
    return [(h, parts(left.get(h, 1)), parts(right.get(h, 1))) for h in sorted({*left, *right})]


def _dealt(df: DataFrame, on: Sequence[str], table: DataFrame | None, own: str, other: str | None,
           names: tuple[str, str], row: Column | None) -> DataFrame:
    """Adds the two numbers: ``own`` by the row's hash, ``other`` (if given)
    by repetition."""
    # a bounded table: at most 2 * MAX_HOT rows
    j = df.withColumn("_h", key_hash(on)).join(F.broadcast(table), "_h", "left").drop("_h")
    h = F.xxhash64(*[F.col(c) for c in df.columns]) if row is None else F.xxhash64(row)
    j = j.withColumn(names[0], F.pmod(h, F.coalesce(F.col(own), F.lit(1))).cast("int"))
    if other is None:
        return j.withColumn(names[1], F.lit(0)).drop("_s", "_t")
    last = F.coalesce(F.col(other), F.lit(1)) - 1
    return j.withColumn(names[1], F.explode(F.sequence(F.lit(0), last))).drop("_s", "_t")


def split_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
               hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT, row: Column | None = None) -> DataFrame:
    """``left JOIN right USING (on)`` with heavy keys spread. Columns other
    than ``on`` must differ between the sides. ``row`` (of the left side) tells
    its rows apart; by default all its columns do, and rows that are equal in
    all of them stay together. NULL keys match nothing, as in any equi-join."""
    on = list(on)
    if how not in HOWS:
        raise ValueError(f"split_join does not do {how}")
    if how in ("left_semi", "left_anti"):
        right = right.select(*on).distinct()            # map-side combined: a key is one row
    heavy_l = heavy_keys(left, on, hot_rows, max_hot)
    heavy_r = {} if how in ("left_semi", "left_anti") else heavy_keys(right, on, hot_rows, max_hot)
    rows = splits(heavy_l, heavy_r, hot_rows)
    if not rows:
        return left.join(right, on, how)
    spark = left.sparkSession
    table = spark.createDataFrame(rows, "_h bigint, _s int, _t int")
    if how == "inner":
        a = _dealt(left, on, table, "_s", "_t", ("_i", "_j"), row)
        b = _dealt(right, on, table, "_t", "_s", ("_j", "_i"), None)
        return a.join(b, [*on, "_i", "_j"], how).drop("_i", "_j")
    if not heavy_r:
        a = _dealt(left, on, table, "_s", None, ("_i", "_j"), row).drop("_j")
        b = _dealt(right, on, table.withColumn("_t", F.lit(1)), "_t", "_s", ("_j", "_i"), None).drop("_j")
        return a.join(b, [*on, "_i"], how).drop("_i")
    # heavy keys on the side that is not kept: inner join on them, plus the
    # kept rows whose key that side does not have (at most MAX_HOT keys do)
    hot = F.col("_h").isin(list(heavy_r))
    part = {side: (df.withColumn("_h", key_hash(on)).where(hot).drop("_h"),
                   df.withColumn("_h", key_hash(on)).where(~hot).drop("_h"))
            for side, df in (("l", left), ("r", right))}
    there = part["r"][0].select(*on).distinct()
    found = split_join(part["l"][0], part["r"][0], on, "inner", hot_rows, max_hot, row)
    alone = part["l"][0].join(F.broadcast(there), on, "left_anti")
    rest = split_join(part["l"][1], part["r"][1], on, "left", hot_rows, max_hot, row)
    return (found.unionByName(alone, allowMissingColumns=True)
            .unionByName(rest.select(found.columns)))
