"""Exactly one row per event id, however late and often its copies come.

At-least-once sources deliver events again. ``DedupSink`` keeps the first copy
that arrived, of any age, without state in the stream:

* ``events/``: the accepted rows, in (event_date, batch) partitions; a replayed
  batch replaces its own;
* ``ids/log/``: the ids each batch accepted, a few files a batch;
* ``ids/runs/a_b/``: sorted runs of the ids of batches a to b, in hash buckets,
  each file with a Bloom filter of its ids. ``compact`` turns the log into a
  run and merges neighbouring runs of like size, so that an id is rewritten
  some log2(batches) times and a lookup meets as many runs.

A batch looks its ids up in the log and, in the runs, in its ids' buckets
only. Few ids (LITERALS) are pushed into the scan, whose Bloom filters and
minima skip the row groups without them; more are joined (broadcast if their
number is checked to be small, else by a shuffle).

Events without an id have no identity and are all kept, those without a time
too. Copies within a batch are reduced to the one with the earliest time (then
the smallest row hash) before any shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_latest
from ..session import delete_folder, list_folders, list_partition_values, path_exists, work_dir
from .jobs import DEFAULT_TRIGGER

LITERALS = 200               # ids of a batch that are looked up by pushed values (a chain of ORs)
SMALL_IDS = 5_000_000        # ids of a batch that may be broadcast


@contextmanager
def pushed_values(spark: SparkSession, n: int) -> Iterator[None]:
    """IN lists of up to ``n`` values reach Parquet as equalities (which its
    Bloom filters can test); the setting is put back."""
    key = "spark.sql.parquet.pushdown.inFilterThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@dataclass(frozen=True)
class DedupSink:
    spark: SparkSession
    root: str
    id_col: str = "event_id"
    ts_col: str = "ts"
    buckets: int | None = None          # 256 for a new sink

    # -- the id index --------------------------------------------------------
    def _buckets(self) -> int:
        """The sink's number of buckets, fixed at its first use."""
        path = f"{self.root}/settings"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            self.spark.createDataFrame([(json.dumps({"buckets": self.buckets or 256}),)], "value string") \
                .coalesce(1).write.mode("overwrite").text(path)
        held = json.loads(self.spark.read.text(path).first()[0])["buckets"]
        if self.buckets not in (None, held):
            raise ValueError(f"{self.root} has {held} buckets, not {self.buckets}")
        return held

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def runs(self) -> list[tuple[int, int]]:
        """Batch ranges of the finished runs that no wider one holds."""
        out: list[tuple[int, int]] = []
        found = [tuple(map(int, f.split("_"))) for f in list_folders(self.spark, f"{self.root}/ids/runs")
                 if path_exists(self.spark, f"{self.root}/ids/runs/{f}/_SUCCESS")]
        for a, b in sorted(found, key=lambda r: (r[0], -r[1])):
            if not out or b > out[-1][1]:
                out.append((a, b))
        return out

    def _run(self, run: tuple[int, int]) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/ids/runs/{run[0]}_{run[1]}")

    def _logged(self, after: int) -> DataFrame | None:
        path = f"{self.root}/ids/log"
        if not any(int(v) > after for v in list_partition_values(self.spark, path, "_batch_id")):
            return None
        return self.spark.read.parquet(path).where(F.col("_batch_id") > after)

    def _within(self, held: DataFrame, ids: DataFrame, values: list | None, small: bool) -> DataFrame:
        if values is not None:
            return held.where(F.col("id").isin(values)).select("id")
        return held.join(F.broadcast(ids) if small else ids, "id", "left_semi").select("id")

    def known(self, ids: DataFrame, batch_id: int) -> DataFrame:
        """Those of ``ids`` (column ``id``, distinct) that another batch has
        accepted."""
        head = ids.limit(SMALL_IDS + 1).count()
        small = head <= SMALL_IDS
        values = [r[0] for r in ids.collect()] if head <= LITERALS else None
        n, runs = self._buckets(), self.runs()
        out = ids.limit(0)
        log = self._logged(runs[-1][1] if runs else -1)
        if log is not None:
            out = out.unionByName(self._within(log.where(F.col("_batch_id") != batch_id), ids, values, small))
        if runs:        # at most the number of buckets
            touched = [r[0] for r in ids.select(self._bucket(n)).distinct().collect()]
            for run in runs:
                held = self._run(run).where(F.col("bucket").isin(touched) & (F.col("_batch_id") != batch_id))
                out = out.unionByName(self._within(held, ids, values, small))
        return out.distinct()

    def compact(self) -> None:
        """Turn the log into a run; merge runs of like size. Readers see the
        old runs until the new one is finished."""
        runs = self.runs()
        log = self._logged(runs[-1][1] if runs else -1)
        if log is not None:
            batches = sorted(int(v) for v in list_partition_values(self.spark, f"{self.root}/ids/log", "_batch_id"))
            fresh = [b for b in batches if not runs or b > runs[-1][1]]
            self._write_run(log, (fresh[0], fresh[-1]))
        while len(runs := self.runs()) > 1:
            (a, b), (c, d) = runs[-2:]
            left, right = self._run((a, b)), self._run((c, d))
            if left.count() > 2 * right.count():        # counts come from the files' footers
                break
            self._write_run(left.unionByName(right), (a, d))
        kept = set(self.runs())
        for f in list_folders(self.spark, f"{self.root}/ids/runs"):
            if tuple(map(int, f.split("_"))) not in kept:
                delete_folder(self.spark, f"{self.root}/ids/runs/{f}")
        for b in list_partition_values(self.spark, f"{self.root}/ids/log", "_batch_id"):
            if kept and int(b) <= max(r[1] for r in kept):
                delete_folder(self.spark, f"{self.root}/ids/log/_batch_id={b}")

    def _write_run(self, ids: DataFrame, run: tuple[int, int]) -> None:
        n = self._buckets()
        rows = ids.select("id", "_batch_id").withColumn("bucket", self._bucket(n))
        per_file = max(1_000, rows.count() // n)
        (rows.repartition("bucket").sortWithinPartitions("bucket", "id").write.mode("overwrite").partitionBy("bucket")
         .option("parquet.bloom.filter.enabled#id", "true")
         .option("parquet.bloom.filter.expected.ndv#id", str(per_file))
         .parquet(f"{self.root}/ids/runs/{run[0]}_{run[1]}"))

    # -- writing and reading -----------------------------------------------------
    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = self.spark
        work_dir(spark)
        order = [F.col(self.ts_col).asc_nulls_last(), F.xxhash64(*batch.columns)]
        named = batch.where(F.col(self.id_col).isNotNull())
        first = dedup_latest(named, [self.id_col], order).checkpoint(eager=True)
        ids = first.select(F.col(self.id_col).alias("id"))
        with pushed_values(spark, LITERALS):
            old = self.known(ids, batch_id).checkpoint(eager=True)
        fresh = first.join(old.withColumnRenamed("id", self.id_col), self.id_col, "left_anti").select(*batch.columns)
        rows = fresh.unionByName(batch.where(F.col(self.id_col).isNull())) \
            .withColumn("event_date", F.to_date(self.ts_col)).withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "_batch_id").parquet(f"{self.root}/events"))
        accepted = fresh.select(F.col(self.id_col).alias("id"))
        (accepted.withColumn("_batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id").parquet(f"{self.root}/ids/log"))

    def stream(self, events: DataFrame, checkpoint: str, trigger: dict[str, Any] | None = None,
               compact_every: int = 100) -> StreamingQuery:
        def run(df: DataFrame, batch_id: int) -> None:
            self.write_batch(df, batch_id)
            if compact_every and (batch_id + 1) % compact_every == 0:
                self.compact()
        w = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
        return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/events").drop("event_date", "_batch_id")
