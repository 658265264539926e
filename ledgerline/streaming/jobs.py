"""Structured Streaming jobs for the change-data path.

* ``land_changes``: append raw change files to the raw layer as they
  arrive (file sink: exactly-once through its commit log).
* ``apply_changes``: per micro-batch, reduce the changes to the latest per
  key and write them to a change log partitioned by batch id. Writing
  a batch overwrites that batch's partition, so a replayed batch (after
  a failure, the engine re-runs the same batch id with the same data)
  replaces itself instead of adding rows. The current state is a view:
  latest change per key over the log, deletes removed (``current_state``).
  No table is rewritten per micro-batch, so the cost of a batch grows with
  the batch, not with the table; compaction is a separate batch job.
* at-least-once sources deliver some events twice: see ``dedup.py``.
* ``windowed_counts``: tumbling-window counts per event type, without state
  and without a watermark: each micro-batch logs the counts of its own events
  (``emit_counts``), the sum over the log is a window's current count, so an
  event counts however late it comes.

Every job takes its checkpoint location from the caller; ``default_trigger``
is the 30 s processing-time poll, tests pass ``availableNow``.
"""

from __future__ import annotations

import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import bound_literal
from ..operators.dedup import dedup_latest
from ..operators.joins import by_key
from ..session import list_partition_values, path_exists, work_dir
from ..sources.testdata import to_change_envelope
from .cdc import PAYLOAD_SCHEMA

DEFAULT_TRIGGER: dict[str, Any] = {"processingTime": "30 seconds"}
LAG_ALERT_THRESHOLD = 10_000


def stream_path(path: str) -> str:
    """A file stream source needs a directory or a glob; a single file is
    turned into a glob that matches only itself."""
    local = path[len("file:"):] if path.startswith("file:") else path
    if os.path.isfile(local):
        return path[:-1] + "[" + path[-1] + "]"
    return path


def read_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(stream_path(path))


ENVELOPE_SCHEMA = "key BIGINT, seq BIGINT, ts TIMESTAMP_NTZ, op STRING, payload STRING"


def read_change_topic(spark: SparkSession, bootstrap_servers: str, topic: str,
                      starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                      envelope_schema: str = ENVELOPE_SCHEMA) -> DataFrame:
    """Change events from a Kafka topic (JSON envelope in the value), in the
    same shape as ``events_to_changes``. Needs the Kafka connector on the
    classpath; the file-source path is used where it is absent."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    raw = r.load()
    env = F.from_json(F.col("value").cast("string"), envelope_schema)
    return raw.select(env.alias("e")).select("e.*")


def _start(writer, trigger: dict[str, Any] | None) -> Any:
    t = trigger or DEFAULT_TRIGGER
    return writer.trigger(**t)


# ---------------------------------------------------------------------------
# landing
# ---------------------------------------------------------------------------
def land_changes(source: DataFrame, raw_path: str, checkpoint: str,
                 trigger: dict[str, Any] | None = None, name: str | None = None) -> StreamingQuery:
    landed = source.withColumn("_landed_at", F.current_timestamp().cast("timestamp_ntz"))
    w = landed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _start(w.queryName(name) if name else w, trigger).start(raw_path)


# ---------------------------------------------------------------------------
# ordered per-key apply
# ---------------------------------------------------------------------------
def change_order():
    return [F.col("ts").desc_nulls_last(), F.col("seq").desc_nulls_last()]


def latest_changes(changes: DataFrame) -> DataFrame:
    """Latest change per key by (ts, seq)."""
    return dedup_latest(changes, ["key"], change_order())


def write_change_batch(changes: DataFrame, batch_id: int, log_path: str) -> None:
    (latest_changes(changes).withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id").parquet(log_path))


def apply_changes(changes: DataFrame, log_path: str, checkpoint: str,
                  trigger: dict[str, Any] | None = None) -> StreamingQuery:
    w = (changes.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: write_change_batch(df, bid, log_path)))
    return _start(w, trigger).start()


def live_rows(latest: DataFrame) -> DataFrame:
    """Latest-change rows -> current rows: deletes removed, payload typed."""
    return latest.where(F.col("op") != "d").select(
        "key", "seq", "ts", "op", F.from_json("payload", PAYLOAD_SCHEMA).getField("k").alias("k"))


def current_state(change_log: DataFrame) -> DataFrame:
    """Current row per key: the latest change over all batches, keys whose
    latest change is a delete removed. Payload parsed to typed columns."""
    return live_rows(latest_changes(
        change_log.drop("_batch_id") if "_batch_id" in change_log.columns else change_log))


TAIL_KEYS_BROADCAST_MAX = 5_000_000


def merge_tail(base: DataFrame | None, tail: DataFrame) -> DataFrame:
    """Latest change per key over a snapshot (one row per key) plus newer
    change batches: rows of untouched keys pass through an anti join, and only
    the touched keys are re-ranked with the tail. When the tail touches few
    keys (checked) these joins broadcast them and the snapshot is not
    shuffled; the bound changes the plan only. NULL keys are one key."""
    tail_latest = latest_changes(tail)
    if base is None:
        return tail_latest
    keys = tail_latest.select("key")
    small = keys.limit(TAIL_KEYS_BROADCAST_MAX + 1).count() <= TAIL_KEYS_BROADCAST_MAX
    unchanged = by_key(base, keys, ["key"], "left_anti", small)
    touched = latest_changes(by_key(base, keys, ["key"], "left_semi", small).unionByName(tail_latest))
    return unchanged.unionByName(touched)


def events_to_changes(events: DataFrame) -> DataFrame:
    return to_change_envelope(events)


def sink_parquet(df: DataFrame, path: str, checkpoint: str,
                 trigger: dict[str, Any] | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _start(w, trigger).start(path)


# ---------------------------------------------------------------------------
# windowed counts
# ---------------------------------------------------------------------------
def windowed_counts(events: DataFrame, window: str = "1 hour",
                    ts_col: str = "ts", by: str = "event_type") -> DataFrame:
    """A count of 1 per event in its tumbling window (whole multiples of
    ``window`` since 1970); ``emit_counts`` adds them up. Events without a time
    count in a window without bounds."""
    size = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {window})")
    at = F.unix_micros(F.col(ts_col).cast("timestamp"))
    start = at - F.pmod(at, size)
    return events.select(F.timestamp_micros(start).cast("timestamp_ntz").alias("window_start"),
                         F.timestamp_micros(start + size).cast("timestamp_ntz").alias("window_end"),
                         F.col(by), F.lit(1).cast("bigint").alias("event_count"))


def write_count_updates(updates: DataFrame, batch_id: int, log_path: str) -> None:
    keys = [c for c in updates.columns if c != "event_count"]
    (updates.groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
        .withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id").parquet(log_path))


def emit_counts(counts: DataFrame, log_path: str, checkpoint: str,
                trigger: dict[str, Any] | None = None) -> StreamingQuery:
    w = (counts.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: write_count_updates(df, bid, log_path)))
    return _start(w, trigger).start()


def current_counts(log: DataFrame, keys: tuple[str, ...] = ("window_start", "window_end", "event_type")) -> DataFrame:
    """Count per window and group: the sum of what the batches logged (a
    replayed batch has replaced its own rows)."""
    return log.groupBy(*keys).agg(F.sum("event_count").alias("event_count"))


# ---------------------------------------------------------------------------
# lag
# ---------------------------------------------------------------------------
def pipeline_lag(events: DataFrame, committed: DataFrame, ts_col: str = "ts",
                 threshold: int = LAG_ALERT_THRESHOLD) -> DataFrame:
    """Per consumer (``committed``: consumer_name, committed_ts): events
    newer than its committed position, the newest such event time, and an
    alert flag above ``threshold`` pending events. A consumer that has
    committed nothing has nothing pending that can be told.

    For any number of consumers: events are counted per time first (map-side),
    then times and positions are range-sorted together, and a position's
    pending events are the counts after it in its range (a window) plus the
    totals of the later ranges (one row per range)."""
    spark = events.sparkSession
    work_dir(spark)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = events.where(F.col(ts_col).isNotNull()).groupBy(F.col(ts_col).alias("_at")).agg(
        F.count("*").alias("_n"), F.lit(False).alias("_mark"))
    marks = committed.where(F.col("committed_ts").isNotNull()).select(
        F.col("committed_ts").alias("_at"), F.lit(0).cast("bigint").alias("_n"), F.lit(True).alias("_mark")).distinct()
    both = (counted.unionByName(marks).repartitionByRange(n, "_at")
            .withColumn("_range", F.spark_partition_id()).checkpoint(eager=True))
    # equal times share a range; a position comes before the events of its own
    # time here, which are not after it
    after = Window.partitionBy("_range").orderBy(F.col("_at").desc(), F.col("_mark").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    own = both.withColumn("_own", F.coalesce(F.sum("_n").over(after), F.lit(0))).where("_mark")
    totals = both.groupBy("_range").agg(F.sum("_n").alias("_total"))
    later = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", F.coalesce(F.sum("_total").over(later), F.lit(0)).alias("_later"))
    newest = both.where("NOT _mark").agg(F.max("_at")).first()[0]
    pending = own.join(F.broadcast(totals), "_range").select("_at", (F.col("_own") + F.col("_later")).alias("_pending"))
    n = F.coalesce(F.col("_pending"), F.lit(0)).cast("bigint")
    newest = F.lit(None).cast(events.schema[ts_col].dataType) if newest is None else bound_literal(newest)
    return committed.join(pending, F.col("committed_ts") == F.col("_at"), "left").select(
        "consumer_name", "committed_ts", n.alias("pending_events"),
        F.when(n > 0, newest).alias("newest_event_ts"), (n > threshold).alias("alert"))


def progress_lag(query: StreamingQuery) -> dict[str, Any]:
    """Lag figures from the last progress report of a running query."""
    p = query.lastProgress or {}
    return {"batch_id": p.get("batchId"), "input_rows": p.get("numInputRows"),
            "rows_per_second": p.get("processedRowsPerSecond"),
            "sources": [{"description": s.get("description"), "start": s.get("startOffset"),
                         "end": s.get("endOffset"), "latest": s.get("latestOffset")}
                        for s in p.get("sources", [])]}


# ---------------------------------------------------------------------------
# compaction of the change log
# ---------------------------------------------------------------------------
def _list_ids(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(v) for v in list_partition_values(spark, path, prefix))


def _snapshots(spark: SparkSession, root: str) -> list[int]:
    """Ids of committed snapshots; a directory without its commit mark is the
    rest of an interrupted compaction, which the next one overwrites."""
    return [n for n in _list_ids(spark, f"{root}/snapshot", "upto")
            if path_exists(spark, f"{root}/snapshot/upto={n}/_SUCCESS")]


def state_view(spark: SparkSession, root: str) -> DataFrame:
    """Current state under ``root``: the newest snapshot (``snapshot/upto=N``)
    merged with the change-log batches after N (see ``merge_tail``). Read
    cost follows the snapshot scan and the un-compacted tail, not the whole
    history, and the snapshot is not shuffled when the tail is small."""
    snaps = _snapshots(spark, root)
    upto = snaps[-1] if snaps else -1
    tail = spark.read.parquet(f"{root}/log").where(F.col("_batch_id") > upto).drop("_batch_id")
    base = spark.read.parquet(f"{root}/snapshot/upto={upto}") if snaps else None
    return live_rows(merge_tail(base, tail))


def compact(spark: SparkSession, root: str) -> int | None:
    """Fold the change log up to its newest batch into a new snapshot
    directory: the latest change per key, deletes included as tombstones
    (a change that arrives late, in a later batch, but is older than the
    delete must not bring the key back). Never overwrites what it reads;
    older snapshots and log batches can be expired afterwards. Returns N."""
    ids = _list_ids(spark, f"{root}/log", "_batch_id")
    if not ids:
        return None
    snaps = _snapshots(spark, root)
    upto = ids[-1]
    if snaps and snaps[-1] >= upto:
        return snaps[-1]
    prev = snaps[-1] if snaps else -1
    tail = spark.read.parquet(f"{root}/log").where(
        (F.col("_batch_id") > prev) & (F.col("_batch_id") <= upto)).drop("_batch_id")
    base = spark.read.parquet(f"{root}/snapshot/upto={prev}") if snaps else None
    merge_tail(base, tail).write.mode("overwrite").parquet(f"{root}/snapshot/upto={upto}")
    return upto
