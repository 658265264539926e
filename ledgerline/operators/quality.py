"""Data-quality checks: not_null, unique, accepted values, expressions,
relationships, singular tests, freshness; a suite summary and a gate.

Plan shape, chosen for very large tables:

* all row-level checks of one table (not_null, accepted values,
  expressions) compile to ONE aggregate of ``count_if`` columns, so the
  table is scanned once whatever the number of checks;
* ``unique`` is a group-by on the key (partial aggregation map-side, so a
  hot key is combined before the shuffle);
* ``relationships`` first reduces the child to its distinct foreign keys
  with counts (again map-side combined), then anti-joins the parent keys;
  all foreign keys of one child table share that single pass.

Three-valued logic follows the SQL tests: an expression or accepted-values
check fails only when the predicate is FALSE; NULL passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import swap_folder

SUMMARY_SCHEMA = ("check_name", "table_name", "failing_rows", "severity", "status")


@dataclass(frozen=True)
class RowCheck:
    """A row-level check: a row fails when ``fails`` is TRUE."""
    name: str
    fails: Column
    key: Column | None = None  # identifies failing rows in stored failures
    severity: str = "error"


def not_null(c: str, severity: str = "error") -> RowCheck:
    return RowCheck(f"not_null_{c}", F.col(c).isNull(), severity=severity)


def expression_is_true(name: str, expr: str | Column, severity: str = "error") -> RowCheck:
    e = F.expr(expr) if isinstance(expr, str) else expr
    # NOT e is NULL when e is NULL; coalesce to "passes"
    return RowCheck(name, F.coalesce(~e, F.lit(False)), severity=severity)


def accepted_values(c: str, values: Iterable[str], severity: str = "error") -> RowCheck:
    vals = list(values)
    return RowCheck(f"accepted_values_{c}", F.coalesce(~F.col(c).isin(*vals), F.lit(False)),
                    severity=severity)


def row_check_counts(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """One pass over ``df``: failing-row count per check, one row each."""
    aggs = [F.count_if(ch.fails).cast("bigint").alias(f"c{i}") for i, ch in enumerate(checks)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{ch.name}', '{ch.severity}', c{i}" for i, ch in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) AS (check_name, severity, failing_rows)") \
        .select("check_name", F.lit(table).alias("table_name"), "failing_rows", "severity")


def row_check_failures(df: DataFrame, table: str, checks: Sequence[RowCheck],
                       key: Column) -> DataFrame:
    """Failing rows of every row-level check (check_name, table_name,
    key_value, failing_rows=1) in one pass: an array of the names of the
    checks a row fails, exploded."""
    names = F.array_compact(F.array(*[F.when(ch.fails, F.lit(ch.name)) for ch in checks]))
    return (df.select(key.cast("string").alias("key_value"), names.alias("_failed"))
              .where(F.size("_failed") > 0)
              .select(F.explode("_failed").alias("check_name"), F.lit(table).alias("table_name"),
                      "key_value", F.lit(1).cast("bigint").alias("failing_rows")))


def duplicate_keys(df: DataFrame, keys: Sequence[str], ignore_null: bool = True) -> DataFrame:
    """Keys seen more than once, with their row count (n_rows)."""
    src = df
    if ignore_null:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        src = df.where(cond)
    return (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
               .where(F.col("n_rows") > 1))


def key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def unique_failures(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    name = "unique_" + "_".join(keys)
    return duplicate_keys(df, keys).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
        key_text(keys).alias("key_value"), F.col("n_rows").cast("bigint").alias("failing_rows"))


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                count_null: bool = False) -> DataFrame:
    """Child foreign keys with no parent row, with the number of child rows
    carrying each; a NULL key counts as one only with ``count_null``. The child is first collapsed to one row per
    key, so the anti join shuffles distinct keys, not child rows."""
    keys = ((child if count_null else child.where(F.col(fk).isNotNull()))
                 .groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(pk).alias("_pk"))
    return keys.join(parents, keys["_fk"] == parents["_pk"], "left_anti")


def relationship_failures(child: DataFrame, table: str, fk: str, parent: DataFrame,
                          parent_name: str, pk: str) -> DataFrame:
    name = f"relationships_{table}_{fk}_to_{parent_name}"
    return orphan_keys(child, fk, parent, pk).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
        F.col("_fk").cast("string").alias("key_value"),
        F.col("n_rows").cast("bigint").alias("failing_rows"))


def relationship_failures_multi(child: DataFrame, table: str,
                                rels: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """All relationship checks of one child table in one pass: the foreign
    key columns are stacked into (check, value) pairs, collapsed to distinct
    values with their row counts (map-side combined), and anti-joined once
    against the parents' keys tagged with the same check index.
    ``rels``: (fk column, parent frame, parent name, parent key)."""
    from pyspark.sql import types as T

    key_types = {child.schema[fk].dataType for fk, _, _, _ in rels}
    kt = key_types.pop() if len(key_types) == 1 else T.StringType()
    names = [f"relationships_{table}_{fk}_to_{pname}" for fk, _, pname, _ in rels]
    pairs = F.array(*[F.struct(F.lit(i).alias("_r"), F.col(fk).cast(kt).alias("_v"))
                      for i, (fk, _, _, _) in enumerate(rels)])
    keys = (child.select(F.inline(pairs)).where(F.col("_v").isNotNull())
                 .groupBy("_r", "_v").agg(F.count(F.lit(1)).alias("n_rows")))
    parents = None
    for i, (_, parent, _, pk) in enumerate(rels):
        p = parent.select(F.lit(i).alias("_r"), F.col(pk).cast(kt).alias("_v"))
        parents = p if parents is None else parents.unionByName(p)
    orphans = keys.join(parents, ["_r", "_v"], "left_anti")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_r") + 1)
    return orphans.select(name.alias("check_name"), F.lit(table).alias("table_name"),
                          F.col("_v").cast("string").alias("key_value"),
                          F.col("n_rows").cast("bigint").alias("failing_rows"))


def relationship_counts(child: DataFrame, table: str,
                        rels: Sequence[tuple[str, DataFrame, str, str]],
                        severity: str = "error") -> DataFrame:
    """Summary row per relationship check of ``child`` (0 when it passes)."""
    spark = child.sparkSession
    names = spark.createDataFrame([(f"relationships_{table}_{fk}_to_{pname}",)
                                   for fk, _, pname, _ in rels], "check_name string")
    failing = relationship_failures_multi(child, table, rels).groupBy("check_name") \
        .agg(F.sum("failing_rows").alias("failing_rows"))
    # at most one row per check on either side: broadcasting is bounded
    return names.join(F.broadcast(failing), "check_name", "left").select(
        "check_name", F.lit(table).alias("table_name"),
        F.coalesce(F.col("failing_rows"), F.lit(0)).cast("bigint").alias("failing_rows"),
        F.lit(severity).alias("severity"))


def count_failures(failures: DataFrame, check_name: str, table: str,
                   severity: str = "error") -> DataFrame:
    """Summary row for a check given as failing keys (sum of rows); an
    empty input still yields one row with 0."""
    return failures.agg(F.coalesce(F.sum("failing_rows"), F.lit(0)).cast("bigint").alias("failing_rows")) \
        .select(F.lit(check_name).alias("check_name"), F.lit(table).alias("table_name"),
                "failing_rows", F.lit(severity).alias("severity"))


def with_status(summary: DataFrame) -> DataFrame:
    st = F.when(F.col("failing_rows") == 0, "pass") \
          .when(F.col("severity") == "warn", "warn").otherwise("fail")
    return summary.select(*SUMMARY_SCHEMA[:4], st.alias("status"))


# ---------------------------------------------------------------------------
# freshness
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Freshness:
    warn_after_hours: int = 12
    error_after_hours: int = 24


def source_freshness(tables: dict[str, DataFrame], loaded_at: str, as_of: str,
                     rule: Freshness = Freshness()) -> DataFrame:
    """Per source: max(loaded_at), age in hours at ``as_of``, status
    (error > error_after, warn > warn_after, else pass; no rows = error)."""
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
                       .select(F.lit(name).alias("source_name"), "max_loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    age_s = F.unix_micros(as_of_ts.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))
    age_h = (age_s / F.lit(3_600_000_000)).cast("decimal(18,2)")
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
               .when(age_h > rule.error_after_hours, "error")
               .when(age_h > rule.warn_after_hours, "warn")
               .otherwise("pass"))
    return out.select("source_name", "max_loaded_at", age_h.alias("age_hours"), status.alias("status"))


# ---------------------------------------------------------------------------
# suite and gate
# ---------------------------------------------------------------------------
@dataclass
class TableChecks:
    table: str
    df: DataFrame
    row_checks: list[RowCheck] = field(default_factory=list)
    unique: list[Sequence[str]] = field(default_factory=list)
    relationships: list[tuple[str, DataFrame, str, str]] = field(default_factory=list)
    failure_key: Column | None = None
    severity: str = "error"  # of the unique and relationship checks


def suite_summary(specs: Sequence[TableChecks]) -> DataFrame:
    parts: list[DataFrame] = []
    for s in specs:
        if s.row_checks:
            parts.append(row_check_counts(s.df, s.table, s.row_checks))
        for keys in s.unique:
            parts.append(count_failures(unique_failures(s.df, s.table, keys),
                                        "unique_" + "_".join(keys), s.table, s.severity))
        if s.relationships:
            parts.append(relationship_counts(s.df, s.table, s.relationships, s.severity))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_status(out)


def suite_failures(specs: Sequence[TableChecks]) -> DataFrame:
    """Every failing row / key of the suite (check_name, table_name,
    key_value, failing_rows), ready to append to a failures table."""
    parts: list[DataFrame] = []
    for s in specs:
        if s.row_checks:
            key = s.failure_key if s.failure_key is not None else F.lit(None)
            parts.append(row_check_failures(s.df, s.table, s.row_checks, key))
        for keys in s.unique:
            parts.append(unique_failures(s.df, s.table, keys))
        if s.relationships:
            parts.append(relationship_failures_multi(s.df, s.table, s.relationships))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    """``failed``: (check_name, table_name, failing_rows) of the failed checks."""

    def __init__(self, message: str, failed: Sequence[tuple] = ()):
        super().__init__(message)
        self.failed = [tuple(r) for r in failed]


def gate(summary: DataFrame) -> None:
    """Raise if any error-severity check failed (blocks the publish step).
    Only the failed summary rows (one per check) reach the driver."""
    failed = summary.where(F.col("status") == "fail").select("check_name", "table_name",
                                                            "failing_rows").collect()
    if failed:
        desc = ", ".join(f"{r.check_name}@{r.table_name}={r.failing_rows}" for r in failed)
        raise QualityGateError(f"data quality gate failed: {desc}", failed)


def store_failures(failures: DataFrame, path: str, run_id: str) -> None:
    """Append the failing rows of one test run to the failures table,
    partitioned by run id (a re-run of the same id replaces its rows)."""
    (failures.withColumn("run_id", F.lit(run_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run_id").parquet(path))


def publish(candidate: DataFrame, path: str, checks, partition_by=(), run_id: str = "candidate") -> DataFrame:
    """Write-audit-publish of a path table: write the candidate next to the
    target, run the checks on what was written (``checks(df) ->
    list[TableChecks]``), and only when the gate passes put its folder in the
    target's place, files, clustering and all. A failing gate raises and leaves
    the published table as it was. Returns the summary. (A catalog table is
    swapped in one change: ``operators/versions.py``.)"""
    spark = candidate.sparkSession
    cand_path = f"{path.rstrip('/')}_candidates/{run_id}"
    w = candidate.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(cand_path)
    summary = suite_summary(checks(spark.read.parquet(cand_path)))
    # the checks' counts: one row per check, fixed before the folder moves
    rows = summary.collect()
    summary = spark.createDataFrame(rows, summary.schema)
    gate(summary)
    swap_folder(spark, cand_path, path)
    return summary
