"""Incremental loader: watermark control table, append to raw, audit.

One load of one table:

1. read the table's committed watermark from the control table (one
   row per commit; the latest batch wins) - a single scalar;
2. build the extract (full on first run, incremental after);
3. append it to ``raw/<table>`` partitioned by ``_batch_id`` while an
   ``Observation`` collects row count and min/max of the watermark
   column in the same pass - the data never goes through the driver;
4. if the batch was empty, commit nothing (watermark unchanged);
   otherwise append the new watermark row, then the audit row.

Write-then-commit gives at-least-once delivery. A re-run after a crash
between 3 and 4 reuses the same batch id and, with dynamic partition
overwrite, replaces that batch's partition instead of duplicating it;
any overlap that remains is removed by the staging dedup.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists
from .extract import SourceSpec, extract, extract_after

CONTROL_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("watermark", T.TimestampNTZType(), True),
    T.StructField("row_count", T.LongType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("watermark_key", T.StringType(), True),
])

AUDIT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("load_mode", T.StringType(), False),
    T.StructField("row_count", T.LongType(), False),
    T.StructField("min_watermark", T.TimestampNTZType(), True),
    T.StructField("max_watermark", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), False),
])


@dataclass
class LoadResult:
    table_name: str
    batch_id: int
    load_mode: str
    row_count: int
    min_watermark: Any
    max_watermark: Any
    committed: bool


class IncrementalLoader:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.control_path = f"{self.root}/_control/watermarks"
        self.audit_path = f"{self.root}/_control/load_audit"
        # commits to the shared control tables are serialised; the loads
        # themselves (different raw paths) run concurrently
        self._commit_lock = threading.Lock()
        # last commit per table: read from the control table once, then
        # kept up to date by this loader's own commits
        self._positions: dict[str, tuple] | None = None

    def raw_path(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    # -- control table ---------------------------------------------------
    def state(self) -> DataFrame:
        """Current watermark per table (latest committed batch)."""
        if not path_exists(self.spark, self.control_path):
            return self.spark.createDataFrame([], CONTROL_SCHEMA)
        log = self.spark.read.schema(CONTROL_SCHEMA).parquet(self.control_path)
        return log.groupBy("table_name").agg(
            F.max_by(F.struct("watermark", "row_count", "batch_id", "watermark_key"),
                     F.col("batch_id")).alias("s")) \
            .select("table_name", "s.watermark", "s.row_count", "s.batch_id", "s.watermark_key")

    def last_commit(self, table: str):
        """(watermark, watermark_key, batch_id) of the latest commit."""
        with self._commit_lock:
            if self._positions is None:
                # one row per table: bounded by the number of tables
                self._positions = {r.table_name: (r.watermark, r.watermark_key, r.batch_id)
                                   for r in self.state().collect()}
            return self._positions.get(table, (None, None, 0))

    def audit(self) -> DataFrame:
        if not path_exists(self.spark, self.audit_path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.audit_path)

    # -- one load --------------------------------------------------------
    def load(self, spec: SourceSpec, source: DataFrame, extracted_at: Any = None,
             interval_start: Any = None) -> LoadResult:
        watermark, watermark_key, last_batch = self.last_commit(spec.name)
        batch_id = last_batch + 1
        if spec.mode == "ge":
            bound, mode = interval_start, ("interval" if interval_start is not None else "full")
        else:
            bound, mode = watermark, ("incremental" if watermark is not None else "full")
        if spec.mode == "gt_key":
            key_type = source.schema[spec.key[0]].dataType
            wm_key = F.lit(watermark_key).cast(key_type) if watermark_key is not None else None
            batch = extract_after(source, spec, bound, wm_key, extracted_at)
        else:
            batch = extract(source, spec, bound, extracted_at)
        obs = Observation(f"load_{spec.name}_{batch_id}")
        c = F.col(spec.incremental_col)
        metrics = [F.count(F.lit(1)).alias("row_count"), F.min(c).alias("min_wm"), F.max(c).alias("max_wm")]
        if spec.mode == "gt_key":
            # max over (ts, key) in the key's own type (text would order "9" > "10")
            metrics.append(F.max(F.struct(c.alias("ts"), F.col(spec.key[0]).alias("k"))).alias("max_pos"))
        observed = batch.observe(obs, *metrics)
        (observed.withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("_batch_id").parquet(self.raw_path(spec.name)))
        m = obs.get
        n = int(m.get("row_count", 0) or 0)
        res = LoadResult(spec.name, batch_id, mode, n, m.get("min_wm"), m.get("max_wm"), n > 0)
        pos_key = None
        if spec.mode == "gt_key" and m.get("max_pos") is not None:
            pos_key = str(m["max_pos"]["k"])
        with self._commit_lock:
            if n > 0:
                self._append(self.control_path, CONTROL_SCHEMA,
                             [(spec.name, _ntz(res.max_watermark), n, batch_id, pos_key)])
                if self._positions is not None:
                    self._positions[spec.name] = (_ntz(res.max_watermark), pos_key, batch_id)
            self._append(self.audit_path, AUDIT_SCHEMA,
                         [(spec.name, batch_id, mode, n, _ntz(res.min_watermark),
                           _ntz(res.max_watermark), "loaded" if n > 0 else "empty")])
        return res

    def run_tables(self, work: Sequence[Callable[["IncrementalLoader"], object]],
                   parallelism: int = 4) -> list:
        """Run one callable per table concurrently (each does that table's
        loads in order). Spark schedules the jobs of all threads on the
        same executors, as a scheduler running one task per table would."""
        sc = self.spark.sparkContext

        def run(i: int, w):
            # per-thread properties: with spark.scheduler.mode=FAIR each
            # table's jobs share the executors in their own pool
            sc.setLocalProperty("spark.scheduler.pool", f"load_{i}")
            sc.setJobDescription(f"load task {i}")
            return w(self)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            return [f.result() for f in [pool.submit(run, i, w) for i, w in enumerate(work)]]

    def read_raw(self, table: str) -> DataFrame:
        # partition discovery would type _batch_id as int
        df = self.spark.read.parquet(self.raw_path(table))
        return df.withColumn("_batch_id", F.col("_batch_id").cast("bigint"))

    def _append(self, path: str, schema: T.StructType, rows: list[tuple]) -> None:
        # one small row per load: a single output file
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _ntz(v: Any) -> Any:
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v
