"""Row-level changes on plain parquet tables (no MERGE on parquet).

Pure functions compute the new rows; the ``*_table`` variants apply them
to a path-based partitioned table, rewriting only
the partitions that change:

1. find the touched partition values (one row per partition of the table) and
   turn them into literal filters, so the scan of the target is pruned to
   those partitions;
2. write their new content once, with dynamic partition overwrite: Spark
   writes beside the table and swaps the partitions' files in at the job's
   commit, so the job may read the table it overwrites and a failed or retried
   task leaves the old files in place;
3. files of the scope that are still there afterwards belong to partitions
   that got no row: they are replaced by one file without rows.

A batch is materialised once (reliable ``checkpoint()`` in
``spark.checkpoint.dir``): finding the touched partitions and merging read the
same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col_
from ..session import copy_file, delete_files, first_file, scratch_path, work_dir
from .dedup import dedup_latest
from .joins import by_key

LITERALS = 10_000            # partition values in one filter; more make more filters


# ---------------------------------------------------------------------------
# pure DataFrame operations
# ---------------------------------------------------------------------------
def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``INSERT INTO t(cols) SELECT``: match target columns by name, cast
    to the target types, missing columns NULL."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Column DEFAULTs: NULL (or missing) -> default value/expression."""
    out = df
    for c, v in defaults.items():
        dv = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), dv) if c in df.columns else dv)
    return out


def assign_identity(df: DataFrame, id_col: str, start: int | Column,
                    order_by: Sequence[str | Column]) -> DataFrame:
    """Dense ids ``start + 1, start + 2, ...`` in ``order_by`` order without
    a single-partition window.

    The frame is range-partitioned and sorted by ``order_by`` and
    checkpointed (reliable checkpoint in the shared dir, so the numbering
    is computed once and survives executor loss). Each row's position
    inside its partition comes from ``monotonically_increasing_id`` (its
    low 33 bits), and the partition's offset from a prefix sum over the
    per-partition counts - a table with one row per partition, broadcast.
    """
    # a row hash as the last sort key lets the range partitioner split a
    # value of order_by shared by very many rows (ties are numbered in an
    # arbitrary but deterministic order)
    orders = [col_(c) for c in order_by] + [F.xxhash64(*df.columns)]
    work_dir(df.sparkSession)
    sorted_df = df.orderBy(*orders).withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = sorted_df.checkpoint(eager=True)
    part = (F.col("_mid") / F.lit(1 << 33)).cast("bigint")
    pos = F.col("_mid") - part * F.lit(1 << 33)
    with_part = sorted_df.withColumn("_p", part).withColumn("_pos", pos)
    counts = with_part.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    base = start if isinstance(start, Column) else F.lit(start)
    return (with_part.join(F.broadcast(offsets.select("_p", "_off")), "_p")
                     .withColumn(id_col, (base + F.col("_off") + F.col("_pos") + 1).cast("bigint"))
                     .drop("_mid", "_p", "_pos", "_off"))


BROADCAST_KEYS_MAX_ROWS = 5_000_000


def insert_new_keys(target: DataFrame, batch: DataFrame, key: Sequence[str],
                    order_by: Sequence[Column]) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``: the rows of ``batch`` to
    append. The batch is first reduced to one row per key (first under
    ``order_by`` wins), then keys already in the target are dropped with a
    LEFT ANTI join on the key only.

    When the batch's keys are few (checked bound), the target is first
    semi-joined with the broadcast batch keys: the large target is only
    scanned and probed, never shuffled, and the anti join runs between
    two batch-sized inputs. The deduplicated batch is materialised once
    (reliable checkpoint) so the size check and the join share it."""
    work_dir(batch.sparkSession)
    first = dedup_latest(batch, key, order_by).checkpoint(eager=True)
    keys = first.select(*key)
    if keys.limit(BROADCAST_KEYS_MAX_ROWS + 1).count() <= BROADCAST_KEYS_MAX_ROWS:
        existing = target.select(*key).join(F.broadcast(keys), list(key), "left_semi").distinct()
    else:
        existing = target.select(*key).distinct()
    return first.join(existing, list(key), "left_anti")


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Any],
                 touch: tuple[str, Any] | None = None) -> DataFrame:
    """``UPDATE t SET c = v WHERE p``; ``touch`` = (column, value) sets an
    auto-updated timestamp on changed rows, as an update trigger would."""
    hit = F.coalesce(predicate, F.lit(False))
    out = df.withColumn("_hit", hit)
    sets = dict(assignments)
    if touch is not None:
        sets[touch[0]] = touch[1]
    for c, v in sets.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.when(F.col("_hit"), val.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out.drop("_hit")


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str],
           order_by: Sequence[Column]) -> DataFrame:
    """Union of target and batch; the first row per key under ``order_by``
    (e.g. latest updated_at) wins.

    Target rows of other keys pass through an anti join untouched and only
    the rows of the batch's keys are re-ranked; NULL keys are one key. When
    the batch has few keys (checked bound) these joins broadcast them, so the
    target is scanned, not shuffled; the bound changes the plan only."""
    keys = batch.select(*key).distinct()
    small = keys.limit(BROADCAST_KEYS_MAX_ROWS + 1).count() <= BROADCAST_KEYS_MAX_ROWS
    unchanged = by_key(target, keys, list(key), "left_anti", small)
    touched = dedup_latest(by_key(target, keys, list(key), "left_semi", small)
                           .unionByName(batch, allowMissingColumns=True), key, order_by)
    return unchanged.unionByName(touched, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# path-based tables
# ---------------------------------------------------------------------------
def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``REBALANCE`` on the partition columns before a partitioned write:
    rows of one directory partition meet in few tasks (few files per
    directory instead of one per upstream task and directory), and AQE
    splits a directory partition that is too large into several tasks, so
    a hot partition does not become one huge file."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    w = rebalanced(df, partition_by).write.mode(mode)
    if partition_by:
        # a full overwrite replaces the whole table, partitions included
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType | None = None,
           partition_by: Sequence[str] = ()) -> None:
    write_table(conform(df, schema) if schema is not None else df, path, partition_by, "append")


def touched_partitions(df: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """Distinct partition values of ``df``: one row per partition of the
    table, as many as its own directory listing has on the driver."""
    return [tuple(r) for r in df.select(*partition_by).distinct().collect()]


def partition_filters(schema: T.StructType, partition_by: Sequence[str],
                      values: Sequence[tuple]) -> list[Column]:
    """Filters on the partition columns that together hold ``values``, each of
    at most LITERALS of them. Several columns are compared as one struct (flat
    IN lists, whatever their length); NULL is a value like another."""
    kinds = [schema[c].dataType for c in partition_by]

    def one(v):
        return F.struct(*[F.lit(x).cast(k).alias(c) for x, k, c in zip(v, kinds, partition_by)])
    values, out = list(values), []
    for lo in range(0, len(values), LITERALS):
        part = values[lo:lo + LITERALS]
        if len(partition_by) == 1:
            c = F.col(partition_by[0])
            found = c.isin([v[0] for v in part if v[0] is not None])
            out.append(F.coalesce(found, F.lit(False)) | c.isNull() if (None,) in part else found)
        else:
            out.append(F.struct(*partition_by).isin([one(v) for v in part]))
    return out


def within(table: DataFrame, scope: Sequence[Column]) -> DataFrame:
    """Rows of ``table`` in any filter of ``scope`` (which exclude one
    another); each filter prunes its own scan."""
    out = None
    for f in scope:
        part = table.where(f)
        out = part if out is None else out.unionByName(part)
    return table.limit(0) if out is None else out


def replace_partitions(spark: SparkSession, path: str, new_rows: DataFrame, partition_by: Sequence[str],
                       scope: Column | Sequence[Column] = ()) -> None:
    """Write ``new_rows`` over the partitions they lie in, once. ``new_rows``
    may be computed from the table itself.

    Partitions within ``scope`` that ``new_rows`` has no row of are emptied:
    their content becomes one file without rows, so that the table's schema can
    still be read when every partition is empty. They are found by the files
    that outlived the write; emptying them takes file operations only."""
    work_dir(spark)
    scope = [scope] if isinstance(scope, Column) else list(scope)

    def files():
        held = within(spark.read.parquet(path), scope)
        return held.select(F.col("_metadata.file_path").alias("_file")).distinct()
    # rows of a file share its path, so a file is one row after the map side
    before = files().checkpoint(eager=True) if scope else None
    (rebalanced(new_rows, partition_by).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    if before is None:
        return
    old = [unquote(r["_file"]) for r in before.join(files(), "_file", "left_semi").collect()]
    if not old:
        return
    blank = scratch_path(spark, "no-rows")
    new_rows.drop(*partition_by).limit(0).write.parquet(blank)
    empty = first_file(spark, blank)
    for folder in sorted({f.rsplit("/", 1)[0] for f in old}):
        copy_file(spark, empty, folder)
    delete_files(spark, old)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str],
                 order_by: Sequence[Column], partition_by: Sequence[str]) -> None:
    """Upsert ``batch`` into the table at ``path``. The partitions of the
    batch and those in which its keys lie now are rewritten, so a key whose
    partition value changes moves; finding them reads only the key columns of
    the table. The batch is materialised once (it is usually derived: scan +
    dedup), then the touched-partition list and the merge read that copy."""
    work_dir(spark)
    batch = batch.checkpoint(eager=True)
    table = spark.read.parquet(path)
    keys = batch.select(*key).distinct()
    small = keys.limit(BROADCAST_KEYS_MAX_ROWS + 1).count() <= BROADCAST_KEYS_MAX_ROWS
    now = by_key(table.select(*dict.fromkeys([*key, *partition_by])), keys, list(key), "left_semi", small)
    parts = touched_partitions(batch.select(*partition_by).unionByName(now.select(*partition_by)),
                               partition_by)
    if not parts:
        return
    scope = partition_filters(table.schema, partition_by, parts)
    merged = upsert(within(table, scope), batch.select(*table.columns), key, order_by)
    replace_partitions(spark, path, merged, partition_by, scope)


def update_table(spark: SparkSession, path: str, predicate: Column,
                 assignments: Mapping[str, Any], partition_by: Sequence[str],
                 touch: tuple[str, Any] | None = None) -> None:
    """Update the rows of ``predicate``; an assignment may change the
    partition column, then the partitions the rows move to are rewritten too."""
    table = spark.read.parquet(path)
    hit = table.where(F.coalesce(predicate, F.lit(False)))
    places = hit.select(*partition_by)
    if set(partition_by) & {*assignments, *([touch[0]] if touch else [])}:
        places = places.unionByName(update_where(hit, predicate, assignments, touch).select(*partition_by))
    parts = touched_partitions(places, partition_by)
    if not parts:
        return
    scope = partition_filters(table.schema, partition_by, parts)
    replace_partitions(spark, path, update_where(within(table, scope), predicate, assignments, touch),
                       partition_by, scope)


def insert_ignore_table(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str],
                        order_by: Sequence[Column], partition_by: Sequence[str] = ()) -> None:
    target = spark.read.parquet(path)
    new_rows = insert_new_keys(target, batch.select(*target.columns), key, order_by)
    # appending to the table being read is safe: the files to read are
    # listed when the plan is made, new files are committed at the end
    append(new_rows, path, partition_by=partition_by)


def deleted_keys(target: DataFrame, source_keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys present in the target but gone from a full key snapshot of the
    source (the batch path cannot see deletes otherwise). Both sides are
    reduced to distinct keys before the anti join."""
    return by_key(target.select(*key).distinct(), source_keys.select(*key).distinct(), list(key), "left_anti")


def delete_missing_table(spark: SparkSession, path: str, source_keys: DataFrame, key: Sequence[str],
                         partition_by: Sequence[str]) -> None:
    """Remove target rows whose key left the source, rewriting only the
    partitions that hold such rows. A NULL key is a key like any other."""
    table = spark.read.parquet(path)
    gone = deleted_keys(table, source_keys, key)
    parts = touched_partitions(by_key(table, gone, list(key), "left_semi"), partition_by)
    if not parts:
        return
    scope = partition_filters(table.schema, partition_by, parts)
    replace_partitions(spark, path, by_key(within(table, scope), gone, list(key), "left_anti"),
                       partition_by, scope)
