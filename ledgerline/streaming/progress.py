"""Progress of all streams of a session, kept as a table.

A listener takes each batch's progress and the end of each query, and appends
them to a table in small files: every ``flush_rows`` reports, when a query ends,
and on ``stop``. ``health`` states, per query, its last batch, its rows per
second, how old that report is, and the failure that ended it.
"""

from __future__ import annotations

import json
import threading
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("query_id string, run_id string, query_name string, event string, batch_id bigint, input_rows bigint, "
          "input_rows_per_second double, processed_rows_per_second double, duration_ms bigint, at string, "
          "sources string, error string")



class ProgressLog(StreamingQueryListener):
    """Use as a context, or ``start`` and ``stop``."""

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = 100):
        self.spark, self.path, self.flush_rows = spark, path, flush_rows
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._writing = threading.Lock()        # two appends at once would share a temporary folder

    def start(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        # events are delivered in order and behind the query: wait for them
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)
        self.flush()

    def __enter__(self) -> ProgressLog:
        return self.start()

    def __exit__(self, *_: Any) -> None:
        self.stop()

    # -- listener ------------------------------------------------------------
    def onQueryStarted(self, event: Any) -> None:
        self._add((str(event.id), str(event.runId), event.name, "started", None, None, None, None, None,
                   event.timestamp, None, None))

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        ends = json.dumps([{"source": s.description, "end": s.endOffset, "latest": s.latestOffset} for s in p.sources])
        self._add((str(p.id), str(p.runId), p.name, "progress", p.batchId, p.numInputRows, _number(p.inputRowsPerSecond),
                   _number(p.processedRowsPerSecond), int(p.batchDuration), p.timestamp, ends, None))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self._add((str(event.id), str(event.runId), None, "ended", None, None, None, None, None, None, None,
                   event.exception))

    # -- table -------------------------------------------------------------------
    def _add(self, row: tuple) -> None:
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.flush_rows
        if full:
            self.flush()

    def flush(self) -> None:
        with self._writing:
            with self._lock:
                rows, self._rows = self._rows, []
            if rows:
                self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def health(self, as_of: Column, stale_minutes: int = 15) -> DataFrame:
        """(query_id, query_name, last_batch, input_rows, last_report, error,
        status) per query: failed, ended, stale or running."""
        log = self.read().withColumn("t", F.to_timestamp("at"))
        order = F.struct(F.coalesce(F.col("t"), F.to_timestamp(F.lit("9999-01-01"))), F.col("batch_id"))
        last = log.groupBy("query_id").agg(
            F.max("query_name").alias("query_name"), F.max("batch_id").alias("last_batch"),
            F.sum("input_rows").alias("input_rows"), F.max("t").alias("last_report"),
            F.max_by("event", order).alias("_last"), F.max_by("error", order).alias("error"))
        stale = F.col("last_report") < as_of - F.expr(f"INTERVAL {stale_minutes} MINUTES")
        return last.withColumn("status", F.when(F.col("error").isNotNull(), "failed")
                               .when(F.col("_last") == "ended", "ended").when(stale, "stale").otherwise("running")) \
            .drop("_last")


def _number(x: float | None) -> float | None:
    return None if x is None or x != x else float(x)
