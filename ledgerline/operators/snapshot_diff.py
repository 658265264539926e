"""Changes between two full snapshots of a table.

A source without a change feed can only be copied whole; the difference of two
copies gives the changes, deletes included, in the envelope of
``streaming/changes.py``, so that one apply serves both.

Only (key, row hash) is shuffled to find the changed keys (a full outer join
of one narrow row per key and side); the whole rows of the changed keys are
then fetched by semi joins, which broadcast the keys when they are few
(checked). NULL keys are one key. Of several rows with one key the row with the
smallest hash counts, on both sides alike; rows that are equal in all columns
are no change however often they occur. Column order and columns that only one
snapshot has matter: a column that is new is a change of every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_latest
from .joins import by_key

SMALL_KEYS = 5_000_000


def _hashed(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One (key, _h) per key; _h: two independent 64-bit hashes of the row."""
    cols = [F.col(c) for c in columns]
    h = F.struct(F.xxhash64(F.lit(1), *cols).alias("a"), F.xxhash64(F.lit(2), *cols).alias("b"))
    return df.select(*key, h.alias("_h")).groupBy(*key).agg(F.min("_h").alias("_h"))


def changed_keys(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, op) of the keys that differ: c created, u updated, d deleted."""
    key = list(key)
    a = _hashed(old, key, old.columns).select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(key)],
                                              F.col("_h").alias("_old"))
    b = _hashed(new, key, new.columns).withColumnRenamed("_h", "_new")
    on = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(key)]
    op = (F.when(F.col("_old").isNull(), "c").when(F.col("_new").isNull(), "d")
          .when(F.col("_old") != F.col("_new"), "u"))
    there = F.col("_new").isNotNull()
    return (b.join(a, on, "full_outer")
            .select(*[F.when(there, F.col(k)).otherwise(F.col(f"_o{i}")).alias(k) for i, k in enumerate(key)],
                    op.alias("op")).where(F.col("op").isNotNull()))


def snapshot_changes(old: DataFrame | None, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key..., op, before, after): ``before`` and ``after`` are whole rows as
    structs. Without an old snapshot every row is read (op r)."""
    key = list(key)

    def rows(df: DataFrame, name: str) -> DataFrame:
        order = [F.xxhash64(F.lit(n), *[F.col(c) for c in df.columns]) for n in (1, 2)]
        one = dedup_latest(df, key, order)
        return one.select(*[F.col(k).alias(f"_{name}{i}") for i, k in enumerate(key)],
                          F.struct(*df.columns).alias(name))
    if old is None:
        first = rows(new, "after")
        return first.select(*[F.col(f"_after{i}").alias(k) for i, k in enumerate(key)], F.lit("r").alias("op"),
                            F.lit(None).cast(first.schema["after"].dataType).alias("before"), "after")
    # found once, read three times: as many rows as there are changes
    changes = changed_keys(old, new, key).checkpoint(eager=True)
    small = changes.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS
    out = changes
    for df, name in ((old, "before"), (new, "after")):
        own = rows(by_key(df, changes, key, "left_semi", small), name)
        on = [F.col(k).eqNullSafe(F.col(f"_{name}{i}")) for i, k in enumerate(key)]
        out = out.join(own, on, "left").drop(*[f"_{name}{i}" for i in range(len(key))])
    return out.select(*key, "op", "before", "after")


def change_records(changes: DataFrame, table: str, key: Sequence[str], at: Column, seq: int = 0) -> DataFrame:
    """Change records (JSON text ``value``) for ``streaming.changes``; ``at``
    is the time of the new snapshot."""
    record = F.struct(F.lit(table).alias("table"), F.lit(seq).cast("bigint").alias("seq"), at.alias("ts"), "op",
                      F.struct(*key).alias("key"), "before", "after")
    return changes.select(F.to_json(record).alias("value"))
