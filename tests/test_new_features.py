"""Snapshot differences, policies, lag of many consumers, stream health,
co-located tables, partition filters: against plain Python and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import policies, snapshot_diff, tables
import ledgerline.plans.scenarios  # noqa: F401  (registers its queries)
from ledgerline.plans.catalog import QUERIES
from ledgerline.streaming import jobs
from ledgerline.streaming.progress import ProgressLog

NOW = {"availableNow": True}
T0 = dt.datetime(2024, 1, 1)


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- snapshot differences -----------------------------------------------------
def test_snapshot_diff_matches_python(spark):
    rnd = random.Random(2)
    cols = "k int, g string, v string"
    old = [(rnd.choice([None, *range(40)]), "a", rnd.choice(["x", "y", None])) for _ in range(50)]
    new = [r if rnd.random() < 0.5 else (r[0], "a", rnd.choice("xyz")) for r in old if rnd.random() < 0.8] \
        + [(i, "b", "n") for i in range(3)]
    old, new = ({(k, g): (k, g, v) for k, g, v in rows} for rows in (old, new))
    a, b = (spark.createDataFrame(list(rows.values()) * 2, cols) for rows in (old, new))   # repeated rows
    got = {(r.k, r.g): (r.op, r.before and tuple(r.before), r.after and tuple(r.after))
           for r in snapshot_diff.snapshot_changes(a, b, ["k", "g"]).collect()}
    want = {key: (("c" if key not in old else "d" if key not in new else "u"), old.get(key), new.get(key))
            for key in {*old, *new} if old.get(key) != new.get(key)}
    assert got == want
    first = snapshot_diff.snapshot_changes(None, b, ["k", "g"])
    assert _set(first.select("after.*")) == sorted(new.values(), key=str)
    assert snapshot_diff.snapshot_changes(a, a, ["k", "g"]).count() == 0
    assert snapshot_diff.snapshot_changes(a.limit(0), a.limit(0), ["k", "g"]).count() == 0


# -- policies --------------------------------------------------------------------
def test_policies_deny_by_default(spark):
    df = spark.createDataFrame([(1, "a@x.org", "de", True), (2, "b@x.org", "fr", True), (3, None, None, False)],
                               "id int, email string, country string, ok boolean")
    rows = [("a", "t", "column", "*", "show"), ("a", "t", "column", "email", "mask_email"),
            ("a", "t", "row", "country", "de"), ("a", "t", "row", "country", "fr"), ("a", "t", "row", "ok", "true"),
            ("b", "t", "column", "id", "show"), ("c", "t", "row", "ok", "true"), ("d", "t", "column", "id", "shown"),
            ("e", "t", "column", "id", "show"), ("e", "t", "column", "id", "null"),
            ("f", "t", "column", "id", "show"), ("f", "t", "row", "nowhere", "x"),
            ("g", "t", "column", "id", "hash"), ("g", "t", "row", "id", "9")]
    table = spark.createDataFrame(rows, policies.POLICY)
    assert _set(policies.as_role(df, "t", table, "a")) == [(1, "a***@x.org", "de", True), (2, "b***@x.org", "fr", True)]
    assert _set(policies.as_role(df, "t", table, "b")) == [(1,), (2,), (3,)]
    assert policies.as_role(df, "t", table, "g").count() == 0
    for role, table_name in (("c", "t"), ("d", "t"), ("e", "t"), ("f", "t"), ("nobody", "t"), ("a", "other")):
        with pytest.raises(policies.PolicyError):
            policies.as_role(df, table_name, table, role)


# -- lag ---------------------------------------------------------------------------
def test_lag_of_many_consumers_matches_python(spark):
    rnd = random.Random(8)
    events = [None if rnd.random() < 0.05 else T0 + dt.timedelta(minutes=rnd.randrange(500)) for _ in range(2000)]
    spots = [(f"c{i}", None if i % 100 == 0 else T0 + dt.timedelta(minutes=rnd.randrange(-20, 520))) for i in range(1500)]
    ev = spark.createDataFrame([(t,) for t in events], "ts timestamp_ntz")
    com = spark.createDataFrame(spots, "consumer_name string, committed_ts timestamp_ntz")
    known = [t for t in events if t]
    want = []
    for c, at in spots:
        later = [t for t in known if at and t > at]
        want.append((c, at, len(later), max(known) if later else None, len(later) > 300))
    assert _set(jobs.pipeline_lag(ev, com, threshold=300)) == sorted(want, key=str)
    assert _set(jobs.pipeline_lag(ev.limit(0), com.limit(1))) == [("c0", None, 0, None, False)]
    assert jobs.pipeline_lag(ev, com.limit(0)).count() == 0


# -- stream health -------------------------------------------------------------------
def test_progress_is_logged_and_failures_show(spark, scratch):
    root = scratch("health")
    events = f"{SF_SMALL}/events.parquet"
    with ProgressLog(spark, f"{root}/progress", flush_rows=1) as log:
        jobs.land_changes(jobs.read_stream(spark, events), f"{root}/raw", f"{root}/ck", NOW, "good").awaitTermination()

        def boom(df, batch_id):
            raise ValueError("no sink")
        q = (jobs.read_stream(spark, events).writeStream.queryName("bad").option("checkpointLocation", f"{root}/ck2")
             .foreachBatch(boom).trigger(**NOW).start())
        with pytest.raises(Exception, match="no sink"):
            q.awaitTermination()
    got = {r.query_name: r for r in log.health(F.current_timestamp()).collect()}
    assert got["good"].status == "ended" and got["good"].input_rows == spark.read.parquet(events).count()
    assert got["bad"].status == "failed" and "no sink" in got["bad"].error


# -- co-located tables ------------------------------------------------------------------
def test_colocated_tables_join_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["colocated_join"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


# -- partition filters --------------------------------------------------------------------
def test_many_values_of_two_partition_columns(spark, scratch):
    """Thousands of touched partitions of two columns: flat filters that prune."""
    path = scratch("wide")
    df = spark.range(300).select((F.col("id") % 20).cast("int").alias("p"), F.when(F.col("id") % 7 != 0, F.concat(
        F.lit("q"), (F.col("id") % 11).cast("string"))).alias("q"), "id")
    tables.write_table(df, path, ["p", "q"])
    table = spark.read.parquet(path)
    values = [(i, f"q{j}") for i in range(600) for j in range(10)] + [(3, None)]
    old = tables.LITERALS
    try:
        for tables.LITERALS in (10_000, 2_500):
            scope = tables.partition_filters(table.schema, ["p", "q"], values)
            assert len(scope) == -(-len(values) // tables.LITERALS)
            got = tables.within(table, scope)
            want = df.where("(q IS NOT NULL AND q <> 'q10') OR (p = 3 AND q IS NULL)")
            assert _set(got.select("id")) == _set(want.select("id"))
    finally:
        tables.LITERALS = old
    plan = tables.within(table, scope[:1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [named_struct" in plan or "PartitionFilters: [struct" in plan


def test_upsert_moves_thousands_of_partitions_in_one_write(spark, scratch):
    path = scratch("days")
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 400).cast("int").alias("p"),
                                    F.lit(0).alias("at"))
    tables.write_table(rows, path, ["p"])
    moved = rows.where("p < 300").select("k", (F.col("p") + 1000).cast("int").alias("p"), F.lit(1).alias("at"))
    tables.upsert_table(spark, path, moved, ["k"], [F.desc("at")], ["p"])
    got = spark.read.parquet(path)
    assert got.count() == 2000 and got.select("k").distinct().count() == 2000
    assert got.where("p < 300").count() == 0 and got.where("p >= 1000").count() == 1500
