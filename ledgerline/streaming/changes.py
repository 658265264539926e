"""Change streams of many tables, with every column of a changed row.

A change record is one JSON object,

    {"table": "orders", "seq": 7, "ts": "2024-01-01 00:00:00", "op": "u",
     "key": {"order_id": 1}, "before": {...}, "after": {...}}

(op: c created, r read by a snapshot, u updated, d deleted), from a file or
topic of any number of tables. ``key``, ``before`` and ``after`` are kept as
VARIANT, so no column is lost, whatever the schema is today.

* ``ChangeLog.write_batch`` parses a micro-batch and writes it once, routed to
  (table, batch) partitions of one log: nothing is shuffled by key on the way
  in, and a replayed batch replaces itself. Records of tables that nobody
  declared are routed alike; records that are no JSON object with a table are
  kept as they came, under REJECTED.
* ``state`` is the latest change per key over the newest snapshot and the
  batches after it, deletes removed, the declared columns typed.
* ``state_as_of`` replays the retained records up to a time.
* ``compact`` folds a table's log into a snapshot; ``expire`` removes batches
  that a snapshot holds.
* ``drift`` compares the payloads with the declared columns.

A key is the declared key columns, typed, as JSON text; so 1 and "1" are one
key of a BIGINT column. Keys taken from ``after`` or ``before`` serve records
without ``key``. NULL keys are one key. Ties of (ts, seq) go by the record's
hash. A value that does not fit its declared type is NULL in the state and
counted by ``drift``; the log keeps it as it came.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_latest
from ..operators.joins import by_key
from ..operators.tables import rebalanced
from ..session import delete_folder, list_partition_values, path_exists
from .jobs import DEFAULT_TRIGGER

REJECTED = "__rejected__"
LOG = ("table_name string, seq bigint, ts timestamp_ntz, op string, key_text string, key variant, "
       "before variant, after variant, value string, _batch_id bigint")
SMALL_KEYS = 5_000_000


@dataclass(frozen=True)
class ChangeTable:
    """Declared shape of a table in the stream."""

    name: str
    key: tuple[str, ...]
    schema: T.StructType

    def typed(self, payload: str, names: Sequence[str] | None = None) -> list[Column]:
        return [_get(payload, f.name, f.dataType).alias(f.name) for f in self.schema
                if names is None or f.name in names]


def _field(name: str) -> str:
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"a variant path cannot name the column {name}")
    return f"$[{quote}{name}{quote}]"


def _get(payload: str, name: str, kind: T.DataType) -> Column:
    return F.try_variant_get(F.col(payload), _field(name), kind.simpleString())


def _part(name: str) -> Column:
    """A part of the record; JSON null is NULL."""
    v = F.try_variant_get("_v", f"$.{name}", "variant")
    return F.when(~F.is_variant_null(v), v)


def read_change_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of change records, one per line, from files."""
    r = spark.readStream.schema("value string").format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_change_topics(spark: SparkSession, bootstrap_servers: str, topics: str,
                       starting_offsets: str = "earliest") -> DataFrame:
    """Stream of change records from topics (a pattern, one topic per table or
    one for all); needs the Kafka connector on the classpath."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribePattern", topics).option("startingOffsets", starting_offsets).load())
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_records(records: DataFrame, tables: Sequence[ChangeTable]) -> DataFrame:
    """Columns of LOG (without the batch) from JSON text ``value``."""
    v = records.select("value", F.try_parse_json("value").alias("_v")).select(
        "value", F.try_variant_get("_v", "$.table", "string").alias("table_name"),
        F.try_variant_get("_v", "$.seq", "bigint").alias("seq"),
        F.try_variant_get("_v", "$.ts", "timestamp_ntz").alias("ts"),
        F.try_variant_get("_v", "$.op", "string").alias("op"),
        *[_part(c).alias(c) for c in ("key", "before", "after")])
    given = F.coalesce(F.col("key"), F.col("after"), F.col("before"))
    key_text = F.when(F.col("table_name").isNull(), F.lit(None))
    for t in tables:
        own = F.to_json(F.struct(*t.typed("_key", t.key)), {"ignoreNullFields": "false"})
        key_text = key_text.when(F.col("table_name") == t.name, own)
    # a table that is not declared has its key as it came
    v = v.withColumn("_key", given).withColumn("key_text", key_text.otherwise(F.to_json("_key")))
    whole = F.col("table_name").isNotNull()
    return v.select(F.when(whole, F.col("table_name")).otherwise(REJECTED).alias("table_name"), "seq", "ts", "op",
                    "key_text", "key", "before", "after", F.when(~whole, F.col("value")).alias("value"))


def change_order() -> list[Column]:
    # the row hash decides between records of one (ts, seq), whatever batch they came in
    return [F.col("ts").desc_nulls_last(), F.col("seq").desc_nulls_last(),
            F.xxhash64("op", F.to_json("before"), F.to_json("after"))]


def latest(changes: DataFrame) -> DataFrame:
    return dedup_latest(changes, ["key_text"], change_order())


@dataclass
class ChangeLog:
    spark: SparkSession
    root: str
    tables: tuple[ChangeTable, ...] = field(default_factory=tuple)

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def table(self, name: str) -> ChangeTable:
        return next(t for t in self.tables if t.name == name)

    # -- writing -------------------------------------------------------------
    def write_batch(self, records: DataFrame, batch_id: int) -> None:
        rows = parse_records(records, self.tables).withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
        (rebalanced(rows, ["table_name", "_batch_id"]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "_batch_id").parquet(self.log_path))

    def stream(self, records: DataFrame, checkpoint: str, trigger: dict[str, Any] | None = None) -> StreamingQuery:
        w = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda df, batch_id: self.write_batch(df, batch_id))
        return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()

    # -- reading ---------------------------------------------------------------
    def records(self, name: str | None = None) -> DataFrame:
        """All retained records, or those of one table (only its partitions
        are read)."""
        if not path_exists(self.spark, self.log_path):
            none = self.spark.range(0).selectExpr(*["CAST(NULL AS {1}) AS {0}".format(*c.split()) for c in LOG.split(", ")])
            return none if name is None else none.where("false")
        log = self.spark.read.schema(LOG).parquet(self.log_path)
        return log if name is None else log.where(F.col("table_name") == name)

    def rejected(self) -> DataFrame:
        return self.records(REJECTED).select("value", "_batch_id")

    def _snapshots(self, name: str) -> list[int]:
        root = f"{self.root}/snapshot/{name}"
        return sorted(int(v) for v in list_partition_values(self.spark, root, "upto")
                      if path_exists(self.spark, f"{root}/upto={v}/_SUCCESS"))

    def _snapshot(self, name: str, upto: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/snapshot/{name}/upto={upto}")

    def _merged(self, base: DataFrame | None, tail: DataFrame) -> DataFrame:
        """Latest change per key over a snapshot and later records. Only keys
        of the tail are ranked again; when they are few (checked) the snapshot
        is probed with them and not shuffled."""
        tail = latest(tail.select("key_text", "seq", "ts", "op", "before", "after"))
        if base is None:
            return tail
        keys = tail.select("key_text")
        small = keys.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS
        same = by_key(base, keys, ["key_text"], "left_anti", small)
        return same.unionByName(latest(by_key(base, keys, ["key_text"], "left_semi", small).unionByName(tail)))

    def _live(self, name: str, rows: DataFrame) -> DataFrame:
        live = rows.where(F.coalesce(F.col("op") != "d", F.lit(True)))
        return live.select(*self.table(name).typed("after"), "op", "seq", "ts")

    def state(self, name: str) -> DataFrame:
        """Current rows of a declared table: its columns, and op, seq and ts
        of the change that made them so."""
        upto = max(self._snapshots(name), default=None)
        tail = self.records(name)
        if upto is None:
            return self._live(name, self._merged(None, tail))
        return self._live(name, self._merged(self._snapshot(name, upto), tail.where(F.col("_batch_id") > upto)))

    def state_as_of(self, name: str, at: str | Column) -> DataFrame:
        """Rows of a table as they were at a time, from the retained records
        with an earlier or equal ts (those without a ts come first of all). The
        newest snapshot that holds nothing later saves reading what it folds."""
        at = F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
        early = F.coalesce(F.col("ts") <= at, F.lit(True))
        for upto in reversed(self._snapshots(name)):
            base = self._snapshot(name, upto)
            if base.where(~early).limit(1).count() == 0:
                tail = self.records(name).where((F.col("_batch_id") > upto) & early)
                return self._live(name, self._merged(base, tail))
        first = self._expired(name)
        if first is not None:
            raise ValueError(f"records of {name} up to batch {first} are expired and no snapshot is that old")
        return self._live(name, self._merged(None, self.records(name).where(early)))

    # -- upkeep ------------------------------------------------------------------
    def _batches(self, name: str) -> list[int]:
        return sorted(int(v) for v in list_partition_values(self.spark, f"{self.log_path}/table_name={name}", "_batch_id"))

    def compact(self, name: str) -> int | None:
        """Fold the table's log up to its newest batch into a new snapshot
        (deletes stay as tombstones: an older change may still come). Nothing
        that is read is overwritten. Returns the batch."""
        batches, snaps = self._batches(name), self._snapshots(name)
        if not batches or snaps and snaps[-1] >= batches[-1]:
            return snaps[-1] if snaps else None
        base = self._snapshot(name, snaps[-1]) if snaps else None
        tail = self.records(name).where((F.col("_batch_id") > (snaps[-1] if snaps else -1))
                                        & (F.col("_batch_id") <= batches[-1]))
        self._merged(base, tail).write.mode("overwrite").parquet(f"{self.root}/snapshot/{name}/upto={batches[-1]}")
        return batches[-1]

    def expire(self, name: str, upto: int) -> int:
        """Remove the table's batches up to ``upto`` from the log; only what a
        snapshot holds may go. Returns the number removed."""
        if upto > max(self._snapshots(name), default=-1):
            raise ValueError(f"no snapshot of {name} holds batch {upto}")
        gone = [b for b in self._batches(name) if b <= upto]
        if gone:        # first the mark, so that an interrupted run is seen as expired
            self.spark.createDataFrame([(upto,)], "upto bigint").coalesce(1).write.mode("append") \
                .json(f"{self.root}/expired/{name}")
        for b in gone:
            delete_folder(self.spark, f"{self.log_path}/table_name={name}/_batch_id={b}")
        return len(gone)

    def _expired(self, name: str) -> int | None:
        path = f"{self.root}/expired/{name}"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema("upto bigint").json(path).agg(F.max("upto")).first()[0]

    # -- schema --------------------------------------------------------------------
    def drift(self) -> DataFrame:
        """(table_name, field, problem, declared_type, seen_type, n_records) of
        the retained records with a row: fields that are not declared
        (``added``), declared fields that a row lacks (``missing``) or whose
        value does not fit the declared type (``type``), and records of tables
        that are not declared (``table``)."""
        rows = self.records().where((F.col("table_name") != REJECTED) & F.col("after").isNotNull())
        names = [t.name for t in self.tables]
        declared = [(t.name, f.name, f.dataType.simpleString()) for t in self.tables for f in t.schema]
        spec = self.spark.createDataFrame(declared, "table_name string, field string, declared_type string")
        fields = self._fields(rows)
        known = fields.where(F.col("table_name").isin(names))
        # a bounded table: one row per declared column
        added = known.join(F.broadcast(spec), ["table_name", "field"], "left_anti") \
            .groupBy("table_name", "field", "seen_type").agg(F.count("*").alias("n_records")) \
            .select("table_name", "field", F.lit("added").alias("problem"),
                    F.lit(None).cast("string").alias("declared_type"), "seen_type", "n_records")
        others = rows.where(~F.col("table_name").isin(names)).groupBy("table_name") \
            .agg(F.count("*").alias("n_records")) \
            .select("table_name", F.lit(None).cast("string").alias("field"), F.lit("table").alias("problem"),
                    F.lit(None).cast("string").alias("declared_type"), F.lit(None).cast("string").alias("seen_type"),
                    "n_records")
        out = added.unionByName(others)
        for t in self.tables:       # one pass per table, two counts per declared column
            own = rows.where(F.col("table_name") == t.name)
            aggs, stack = [], []
            for i, f in enumerate(t.schema):
                raw = F.try_variant_get("after", _field(f.name), "variant")
                bad = raw.isNotNull() & ~F.is_variant_null(raw) & _get("after", f.name, f.dataType).isNull()
                aggs += [F.count_if(raw.isNull()).alias(f"m{i}"), F.count_if(bad).alias(f"b{i}"),
                         F.max(F.when(bad, F.schema_of_variant(raw))).alias(f"s{i}")]
                stack += [f"{i}, 'missing', m{i}, CAST(NULL AS STRING)", f"{i}, 'type', b{i}, s{i}"]
            wide = own.agg(*aggs).selectExpr(f"stack({len(stack)}, {', '.join(stack)}) AS (_i, problem, n_records, seen_type)")
            cols = self.spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(t.schema)],
                                              "_i int, field string, declared_type string")
            out = out.unionByName(wide.where("n_records > 0").join(F.broadcast(cols), "_i").select(
                F.lit(t.name).alias("table_name"), "field", "problem", "declared_type", "seen_type", "n_records"))
        return out

    @staticmethod
    def _fields(rows: DataFrame) -> DataFrame:
        """One row per field of every record's row."""
        return rows.select("table_name", "after").alias("r").lateralJoin(
            rows.sparkSession.tvf.variant_explode(F.col("r.after").outer())).select(
            "table_name", F.col("key").alias("field"), F.schema_of_variant("value").alias("seen_type"))
