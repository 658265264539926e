"""Published catalog tables: written once, checked, swapped by location.

Each publish writes a new version folder beside the old ones, checks what it
wrote, and then points the catalog table at it (``ALTER TABLE ... SET
LOCATION``, one metadata change). Readers see the old rows or the new ones,
never none and never a mixture, and the files of the new version, with their
clustering, are published as they were written. Old versions stay for readers
that have started, until ``retire`` removes them.

Clustering: rows are range-partitioned and sorted by (cluster keys, row hash),
so that a file holds a contiguous range of days and a day with very many rows
is cut into several ranges; Parquet minima and maxima then prune files and row
groups.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, list_folders, path_exists

ROWS_PER_FILE = 5_000_000


def clustered(df: DataFrame, cluster_by: Sequence[str | Column]) -> DataFrame:
    """Range partitions of (cluster keys, row hash), sorted. Spark merges
    small neighbouring ranges; a heavy value of the keys spans several."""
    if not cluster_by:
        return df
    keys = [F.expr(c) if isinstance(c, str) else c for c in cluster_by]
    spot = F.xxhash64(*df.columns)
    return df.repartitionByRange(*keys, spot).sortWithinPartitions(*keys, spot)


def colocate(df: DataFrame, table: str, key: Sequence[str], buckets: int, path: str) -> None:
    """Write a catalog table in sorted hash buckets of ``key``, one file a
    bucket: joins and aggregates of tables with the same buckets on the key
    need no shuffle. A bucket is one task's work; keys that outgrow it are for
    ``operators/skew.py``."""
    (df.repartition(buckets, *key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *key).sortBy(*key).saveAsTable(table))


def with_docs(df: DataFrame, docs: Mapping[str, str]) -> DataFrame:
    """Attach column comments as field metadata (kept by parquet writes)."""
    if not docs:
        return df
    return df.select(*[F.col(c).alias(c, metadata={"comment": docs[c]}) if c in docs else F.col(c)
                       for c in df.columns])


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    table: str                      # database.name
    root: str                       # folder of the versions
    description: str = ""

    def write(self, df: DataFrame, cluster_by: Sequence[str | Column] = (),
              docs: Mapping[str, str] | None = None, rows_per_file: int = ROWS_PER_FILE) -> str:
        """Write a new version, unpublished; returns its folder."""
        path = f"{self.root}/version-{uuid.uuid4().hex[:16]}"
        (clustered(with_docs(df, docs or {}), cluster_by).write
         .option("maxRecordsPerFile", str(rows_per_file)).parquet(path))
        return path

    def swap(self, path: str) -> None:
        """Make a written version the published one. A version with other
        columns replaces the table's definition too; that is not one change, so
        the table is unknown for a moment."""
        spark = self.spark
        version = spark.read.parquet(path)
        if spark.catalog.tableExists(self.table):
            if _columns(spark.table(self.table)) == _columns(version):
                spark.sql(f"ALTER TABLE {self.table} SET LOCATION {quoted(path)}")
                spark.catalog.refreshTable(self.table)
                return
            spark.sql(f"DROP TABLE {self.table}")       # external: no file goes
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                         + (f" COMMENT {quoted(f.metadata['comment'])}" if "comment" in f.metadata else "")
                         for f in version.schema)
        note = f" COMMENT {quoted(self.description)}" if self.description else ""
        spark.sql(f"CREATE TABLE {self.table} ({cols}) USING parquet{note} LOCATION {quoted(path)}")

    def publish(self, df: DataFrame, checks: Callable | None = None, cluster_by: Sequence[str | Column] = (),
                docs: Mapping[str, str] | None = None, rows_per_file: int = ROWS_PER_FILE) -> DataFrame | None:
        """Write, check what was written (``checks(df) -> list[TableChecks]``),
        swap. A failing gate raises; the published version stays, the rejected
        one is kept in its folder. Returns the checks' summary."""
        from .quality import gate, suite_summary

        path = self.write(df, cluster_by, docs, rows_per_file)
        summary = None
        if checks is not None:
            summary = suite_summary(checks(self.spark.read.parquet(path)))
            gate(summary)
        self.swap(path)
        return summary

    def location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name = 'Location'").collect()
        return rows[-1]["data_type"]

    def retire(self, keep: int = 2) -> list[str]:
        """Remove versions but the published one and the ``keep`` newest
        others; returns the names removed."""
        now = self.location().rstrip("/").rsplit("/", 1)[1]
        others = [f for f in list_folders(self.spark, self.root) if f.startswith("version-") and f != now]
        others.sort(key=lambda f: _written(self.spark, f"{self.root}/{f}"), reverse=True)
        for f in others[keep:]:
            delete_folder(self.spark, f"{self.root}/{f}")
        return others[keep:]


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def _written(spark: SparkSession, path: str) -> int:
    """Time at which a version was finished (0: it never was)."""
    from ..session import modified

    return modified(spark, f"{path}/_SUCCESS") if path_exists(spark, f"{path}/_SUCCESS") else 0
