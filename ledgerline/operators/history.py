"""Type-2 history (valid_from / valid_to / is_current).

Batch rebuild from all versions of a table:

* ``timestamp`` strategy: one row per distinct (key, updated_at); a
  version is valid from its timestamp until the next version's;
* ``check`` strategy: consecutive versions whose check columns are equal
  (null-safe ``<=>``) are merged - a version is kept only if some check
  column differs from the previous version.

Incremental apply (``splice``, ``HistoryTable``): versions may arrive in any
order and any number of times, and the history equals the rebuild over all of
them. For every key of a batch the stored versions around the arriving ones are
looked up (the change before the first, the changes after the last); only this
stretch is ranked again, the rest of the key's versions and all other keys pass
through. A version that the check strategy merges away is stored too, unseen by
readers: a late version before it can make it a change.

Versions without a time have no place in a history; ``unplaced`` returns them.
Of several versions with one key and time the last of ``latest_by`` wins, then
the row with the smallest hash, whatever order they arrive in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, path_exists, scratch_path
from .dedup import dedup_latest
from .ordered import HOT_ROWS, neighbours
from .tables import partition_filters, replace_partitions, touched_partitions, within, write_table


def _distinct_versions(df: DataFrame, key: Sequence[str], ts: str,
                       tie_break: Sequence[Column]) -> DataFrame:
    # several rows with one (key, ts): the tie-break decides (e.g. the last
    # extracted wins), then the row hash, so that reruns agree
    order = [*tie_break, F.xxhash64(*df.columns)]
    return dedup_latest(df.where(F.col(ts).isNotNull()), [*key, ts], order)


def _close_ranges(versions: DataFrame, key: Sequence[str], ts: str, hot_rows: int) -> DataFrame:
    # valid_to = next version's timestamp in the key (hot keys are split,
    # see operators/ordered.py)
    n = neighbours(versions, key, ts, hot_rows=hot_rows)
    return (n.withColumn("valid_from", F.col(ts))
             .withColumn("valid_to", F.col("_next"))
             .withColumn("is_current", F.col("_next").isNull())
             .drop("_next", "_is_first"))


def scd2_timestamp(df: DataFrame, key: Sequence[str], ts: str, columns: Sequence[str],
                   tie_break: Sequence[Column] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    v = _distinct_versions(df, key, ts, tie_break).select(*key, ts, *columns)
    return _close_ranges(v, key, ts, hot_rows).select(*key, *columns, "valid_from", "valid_to",
                                                       "is_current")


def scd2_check(df: DataFrame, key: Sequence[str], ts: str, check_cols: Sequence[str],
               columns: Sequence[str] = (), tie_break: Sequence[Column] = (),
               hot_rows: int = HOT_ROWS) -> DataFrame:
    cols = list(dict.fromkeys([*check_cols, *columns]))
    v = _distinct_versions(df, key, ts, tie_break).select(*key, ts, *cols)
    n = neighbours(v, key, ts, lag_cols=check_cols, hot_rows=hot_rows)
    changed = None
    for c in check_cols:
        d = ~F.col(c).eqNullSafe(F.col(f"_prev_{c}"))
        changed = d if changed is None else changed | d
    kept = (n.withColumn("_keep", F.col("_is_first") | changed).where(F.col("_keep"))
             .select(*key, ts, *cols))
    return _close_ranges(kept, key, ts, hot_rows).select(*key, *cols, "valid_from", "valid_to",
                                                          "is_current")


CHANGED = "_changed"         # false: a version that the check strategy merged into the one before
BUCKET_COL = "_key_bucket"


def unplaced(df: DataFrame, ts: str) -> DataFrame:
    """Versions without a time, which no history holds."""
    return df.where(F.col(ts).isNull())


def _latest(latest_by: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in latest_by]


def _versions(df: DataFrame, key: Sequence[str], ts: str, columns: Sequence[str],
              latest_by: Sequence[str]) -> DataFrame:
    """Distinct versions (key, valid_from, columns, latest_by); stored ones
    and arriving ones have the same columns, so the same row hash."""
    held = list(dict.fromkeys([*columns, *latest_by]))
    return _distinct_versions(df.select(*key, F.col(ts).alias("valid_from"), *held), key, "valid_from",
                              _latest(latest_by))


def _ranked(versions: DataFrame, key: Sequence[str], check_cols: Sequence[str], hot_rows: int) -> DataFrame:
    """Adds ``_changed`` and ``_next``, the time of the next change in the key
    (NULL after the last, and on versions that are no change)."""
    if not check_cols:
        n = neighbours(versions, key, "valid_from", hot_rows=hot_rows)
        return n.withColumn(CHANGED, F.lit(True)).drop("_is_first")
    n = neighbours(versions, key, "valid_from", lag_cols=check_cols, hot_rows=hot_rows)
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_prev_{c}"))
    flagged = n.withColumn(CHANGED, F.col("_is_first") | differs) \
        .drop("_next", "_is_first", *[f"_prev_{c}" for c in check_cols])
    changes = neighbours(flagged.where(CHANGED), key, "valid_from", hot_rows=hot_rows).drop("_is_first")
    same = flagged.where(~F.col(CHANGED)).withColumn("_next", F.lit(None).cast(versions.schema["valid_from"].dataType))
    return changes.unionByName(same)


def _ranges(ranked: DataFrame, end: Column) -> DataFrame:
    """valid_to / is_current from ``_next`` and the time at which the stretch
    ends (NULL: with the key)."""
    to = F.when(F.col(CHANGED), F.coalesce(F.col("_next"), end))
    return ranked.withColumn("valid_to", to).withColumn(
        "is_current", F.col(CHANGED) & F.col("valid_to").isNull()).drop("_next")


def _with_key(df: DataFrame, per_key: DataFrame, key: Sequence[str], how: str, small: bool) -> DataFrame:
    """Join of one row per key on NULL-safe keys; ``_touched`` marks matches.
    Keys that are not ``small`` are hinted to a sort-merge join: Spark knows a
    written frame by the size of its compressed files, and would have the driver
    broadcast millions of keys that take 10 MB there."""
    named = per_key.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                           *[c for c in per_key.columns if c not in key], F.lit(True).alias("_touched"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    return df.join(F.broadcast(named) if small else named.hint("merge"), on, how).drop(
        *[f"_k{i}" for i in range(len(key))])


SMALL_KEYS = 100_000         # keys of a batch that are broadcast (some 10 MB on the driver); more are joined by shuffles


def splice(state: DataFrame | None, changes: DataFrame, key: Sequence[str], ts: str, columns: Sequence[str],
           check_cols: Sequence[str] = (), latest_by: Sequence[str] = (),
           hot_rows: int = HOT_ROWS,
           keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The state of a history (see ``published``) after ``changes``, a batch
    of versions in any order. ``check_cols`` (among ``columns``) selects the
    check strategy. ``changes`` is read several times: pass a written batch.

    NULL keys are one key. Per key, one aggregate finds the stretch of stored
    versions that the batch can alter; a key with very many versions is neither
    gathered nor, outside of the stretch, sorted.

    A batch of few keys (SMALL_KEYS) is broadcast and the state only probed; one
    of more is joined by shuffles. ``keep(df, name)`` writes a frame and reads it
    back: with it, each of these steps runs once and the state's rows are
    shuffled once to be told apart."""
    key, columns = list(key), list(dict.fromkeys([*check_cols, *columns]))
    keep = keep or (lambda df, name: df)
    new = keep(_versions(changes, key, ts, columns, latest_by), "versions")
    if state is None:
        return _ranges(_ranked(new, key, check_cols, hot_rows), F.lit(None))
    at, changed = F.col("valid_from"), F.col(CHANGED)
    span = new.groupBy(*key).agg(F.min("valid_from").alias("_lo"), F.max("valid_from").alias("_hi"))
    small = span.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS
    step = (lambda df, name: df) if small else keep
    touched = _with_key(state, span, key, "inner", small)
    # the change before the first arriving version, and the next one after the
    # last; an arriving version can turn the one that follows it into a change
    # or back, so the check strategy goes on to the change after that
    first = touched.groupBy(*key).agg(F.max(F.when(changed & (at < F.col("_lo")), at)).alias("_start"),
                                      F.min(F.when(changed & (at > F.col("_hi")), at)).alias("_end"))
    if check_cols:
        first = step(first, "around")
        again = _with_key(state, first.select(*key, F.col("_end").alias("_at")), key, "inner", small)
        second = again.groupBy(*key).agg(F.min(F.when(changed & (at > F.col("_at")), at)).alias("_end2"))
        first = _with_key(first, second, key, "left", small).drop("_end", "_touched") \
            .withColumnRenamed("_end2", "_end")
    first = step(first, "stretches")
    inside = (F.col("_touched").isNotNull() & (F.col("_start").isNull() | (at >= F.col("_start")))
              & (F.col("_end").isNull() | (at < F.col("_end"))))
    marked = step(_with_key(state, first, key, "left", small).select(*state.columns, inside.alias("_inside")),
                  "marked")
    rest = marked.where(~F.col("_inside")).select(*state.columns)
    stretch = marked.where("_inside").select(*new.columns)
    versions = step(_distinct_versions(stretch.unionByName(new), key, "valid_from", _latest(latest_by)), "stretch")
    ranked = _ranked(versions, key, check_cols, hot_rows)
    ends = _with_key(ranked, first.select(*key, "_end"), key, "left", small).drop("_touched")
    return rest.unionByName(_ranges(ends, F.col("_end")).select(*state.columns))


def published(state: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The history that readers see: one row per change."""
    return state.where(CHANGED).select(*key, *columns, "valid_from", "valid_to", "is_current")


def scd2_merge(history: DataFrame, changes: DataFrame, key: Sequence[str], ts: str,
               columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Apply a batch of versions, in any order, to a published history of the
    timestamp strategy. A version with the key and time of a stored one
    replaces it only by the row hash; see ``splice`` for ``latest_by``."""
    state = history.withColumn(CHANGED, F.lit(True))
    return published(splice(state, changes, key, ts, columns, hot_rows=hot_rows), key, columns)


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    """Stable hash bucket of the key (the history table's partition column)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class HistoryTable:
    """A stored type-2 history: ``root/state`` partitioned by a hash bucket of
    the key, and ``root/settings``, which fixes the number of buckets, the
    columns and the strategy at the first batch; later ones must agree with it.
    A batch reads and rewrites the buckets that hold a key of its own."""

    spark: SparkSession
    root: str
    key: tuple[str, ...]
    ts: str
    columns: tuple[str, ...]
    check_cols: tuple[str, ...] = ()
    latest_by: tuple[str, ...] = ()
    buckets: int | None = None          # 1024 for a new table
    hot_rows: int = HOT_ROWS

    def _settings(self, buckets: int) -> dict:
        return {"buckets": buckets, "key": list(self.key), "ts": self.ts, "columns": list(self.columns),
                "check_cols": list(self.check_cols), "latest_by": list(self.latest_by)}

    def _agreed(self) -> int:
        """The stored number of buckets, once all settings are seen to agree."""
        held = json.loads(self.spark.read.text(f"{self.root}/settings").first()[0])
        mine = self._settings(self.buckets or held["buckets"])
        if mine != held:
            raise ValueError(f"history at {self.root} was made with {held}, not {mine}")
        return held["buckets"]

    def apply(self, changes: DataFrame) -> None:
        kept: list[str] = []

        def keep(df: DataFrame, name: str) -> DataFrame:
            kept.append(scratch_path(self.spark, f"history-{name}"))
            df.write.parquet(kept[-1])
            return self.spark.read.schema(df.schema).parquet(kept[-1])
        try:
            self._apply(keep(changes.select(*dict.fromkeys([*self.key, self.ts, *self.check_cols, *self.columns,
                                                            *self.latest_by])), "batch"), keep)
        finally:
            for folder in kept:
                delete_folder(self.spark, folder)

    def _apply(self, batch: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> None:
        exists = path_exists(self.spark, f"{self.root}/state/_SUCCESS")
        if exists:
            buckets = self._agreed()
        else:
            buckets = self.buckets or 1024
            self.spark.createDataFrame([(json.dumps(self._settings(buckets)),)], "value string") \
                .coalesce(1).write.mode("overwrite").text(f"{self.root}/settings")
        state, path = None, f"{self.root}/state"
        if exists:
            mine = batch.select(key_bucket(self.key, buckets).alias(BUCKET_COL))
            parts = touched_partitions(mine, [BUCKET_COL])      # at most the number of buckets
            table = self.spark.read.parquet(path)
            state = within(table, partition_filters(table.schema, [BUCKET_COL], parts)).drop(BUCKET_COL)
        rows = splice(state, batch, self.key, self.ts, self.columns, self.check_cols, self.latest_by, self.hot_rows,
                      keep).withColumn(BUCKET_COL, key_bucket(self.key, buckets))
        if exists:
            replace_partitions(self.spark, path, rows, [BUCKET_COL])
        else:
            write_table(rows, path, [BUCKET_COL])

    def read(self) -> DataFrame:
        state = self.spark.read.parquet(f"{self.root}/state")
        return published(state, self.key, list(dict.fromkeys([*self.check_cols, *self.columns])))


def scd2_merge_table(spark, path: str, changes: DataFrame, key: Sequence[str], ts: str,
                     columns: Sequence[str], buckets: int | None = None,
                     hot_rows: int = HOT_ROWS) -> HistoryTable:
    """Apply a batch of versions to the history table at ``path``."""
    table = HistoryTable(spark, path, tuple(key), ts, tuple(columns), buckets=buckets, hot_rows=hot_rows)
    table.apply(changes)
    return table
