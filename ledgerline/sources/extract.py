"""Extract from a relational source into the raw layer.

* full scan on the first run, ``col > watermark`` afterwards (strict), or
  ``col >= interval_start`` with no upper bound (interval mode);
* the predicate is a literal, so Catalyst pushes it into the source
  (JDBC ``WHERE``, parquet row-group skipping) - see ``PushedFilters``;
* JDBC reads are partitioned on a numeric key (``numPartitions``
  concurrent range queries), never pulled through one connection;
* every row is stamped with one ``_extracted_at`` per load.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import bound_literal


@dataclass(frozen=True)
class SourceSpec:
    name: str
    incremental_col: str = "updated_at"
    key: tuple[str, ...] = ()
    loaded_at_col: str = "_extracted_at"
    # "gt": col > watermark; "ge": col >= interval start;
    # "gt_key": (col, key[0]) > (watermark, watermark_key) - rows that share
    # the watermark timestamp but were not yet loaded are still picked up
    mode: str = "gt"
    jdbc_options: dict[str, str] = field(default_factory=dict)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_col: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
              fetchsize: int = 10_000, **options: str) -> DataFrame:
    """Partitioned JDBC read: ``num_partitions`` range queries on
    ``partition_col`` run in parallel on the executors."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetchsize)))
    if partition_col is not None:
        r = (r.option("partitionColumn", partition_col).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def jdbc_key_bounds(spark: SparkSession, url: str, table: str, column: str,
                    **options: str) -> tuple[Any, Any]:
    """min/max of the partition column, computed by the source (the
    aggregate runs in the database; one row comes back)."""
    r = spark.read.format("jdbc").option("url", url).option(
        "query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
    for k, v in options.items():
        r = r.option(k, v)
    row = r.load().first()
    return (row[0], row[1]) if row is not None else (None, None)


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str,
                          num_partitions: int = 64, **options: str) -> DataFrame:
    """Full-table JDBC read split into ``num_partitions`` key ranges, the
    bounds taken from the source."""
    lo, hi = jdbc_key_bounds(spark, url, table, column, **options)
    if lo is None:
        return read_jdbc(spark, url, table, **options)
    return read_jdbc(spark, url, table, column, int(lo), int(hi), num_partitions, **options)


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 10_000, **options: str) -> None:
    """Append through JDBC in multi-row batches (one connection per task)."""
    w = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table) \
        .option("batchsize", str(batchsize))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def stamp(df: DataFrame, extracted_at: Any = None, col: str = "_extracted_at") -> DataFrame:
    """Add the load timestamp: ``current_timestamp()`` (one value per
    query) or a fixed value for reproducible runs."""
    v: Column = F.current_timestamp().cast("timestamp_ntz") if extracted_at is None \
        else bound_literal(extracted_at).cast("timestamp_ntz")
    return df.withColumn(col, v)


def extract(source: DataFrame, spec: SourceSpec, watermark: Any = None,
            extracted_at: Any = None) -> DataFrame:
    """Full load when ``watermark`` is None, else the incremental slice."""
    df = source
    if watermark is not None:
        c = F.col(spec.incremental_col)
        bound = bound_literal(watermark)
        df = df.where(c >= bound if spec.mode == "ge" else c > bound)
    return stamp(df, extracted_at, spec.loaded_at_col)


def extract_full(source: DataFrame, spec: SourceSpec, extracted_at: Any = None) -> DataFrame:
    return extract(source, spec, None, extracted_at)


def extract_since(source: DataFrame, spec: SourceSpec, watermark: Any,
                  extracted_at: Any = None) -> DataFrame:
    """Strict ``col > watermark`` slice (rows with a NULL watermark column
    are never picked up incrementally; count them with ``null_watermark_rows``)."""
    return extract(source, SourceSpec(spec.name, spec.incremental_col, spec.key,
                                      spec.loaded_at_col, "gt"), watermark, extracted_at)


def extract_interval(source: DataFrame, spec: SourceSpec, interval_start: Any,
                     extracted_at: Any = None) -> DataFrame:
    """Inclusive ``col >= interval_start`` with no upper bound: consecutive
    runs overlap; the staging dedup absorbs the repeated rows."""
    return extract(source, SourceSpec(spec.name, spec.incremental_col, spec.key,
                                      spec.loaded_at_col, "ge"), interval_start, extracted_at)


def after_position(col: str, key: str, wm: Any, wm_key: Any) -> Column:
    """Lexicographic ``(col, key) > (wm, wm_key)``, written with plain
    comparisons so it is pushed to the source as an OR of ranges."""
    c, k = F.col(col), F.col(key)
    at = bound_literal(wm)
    return (c > at) | ((c == at) & (k > F.lit(wm_key)))


def extract_after(source: DataFrame, spec: SourceSpec, watermark: Any, watermark_key: Any,
                  extracted_at: Any = None) -> DataFrame:
    """Composite-watermark slice: strictly after the last loaded
    (timestamp, key) position."""
    df = source if watermark is None else source.where(
        after_position(spec.incremental_col, spec.key[0], watermark, watermark_key))
    return stamp(df, extracted_at, spec.loaded_at_col)


def null_watermark_rows(source: DataFrame, spec: SourceSpec) -> DataFrame:
    return source.agg(F.count_if(F.col(spec.incremental_col).isNull()).alias("null_watermark_rows"))


def copy_into(spark: SparkSession, path: str, fmt: str, schema, extracted_at: Any = None,
              **options: str) -> DataFrame:
    """Bulk load of staged files (``COPY INTO``): read them with an explicit
    schema (no inference pass) and stamp the load time; append the result
    with ``operators.tables.append``."""
    r = spark.read.format(fmt).schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return stamp(r.load(path), extracted_at)


def load_seed_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Static reference data from a CSV with a header and a fixed schema."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)
