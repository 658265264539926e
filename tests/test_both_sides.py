"""Size switches change plans, never results; NULL keys and partitions; driver clocks."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import ordered, tables
from ledgerline.operators.quality import orphan_keys
from ledgerline.plans import reports
from ledgerline.streaming import jobs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df):
    return sorted(map(str, df.collect()))


def test_neighbours_split_and_plain_agree(spark):
    df = spark.createDataFrame([(k, i, f"v{i}") for k in (None, 1, 2) for i in range(5 + (k or 7))],
                               "k int, o int, v string")
    want = rows(ordered.neighbours(df, ["k"], "o", ["v"], hot_rows=1000))
    assert rows(ordered.neighbours(df, ["k"], "o", ["v"], hot_rows=3)) == want
    assert len(want) == df.count()


@pytest.mark.parametrize("bound", [0, 5_000_000])
def test_upsert_on_both_sides_of_the_bound(spark, monkeypatch, bound):
    monkeypatch.setattr(tables, "BROADCAST_KEYS_MAX_ROWS", bound)
    target = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (None, 1)], "k int, at int")
    batch = spark.createDataFrame([(1, 5), (None, 6), (3, 1)], "k int, at int")
    got = tables.upsert(target, batch, ["k"], [F.col("at").desc()])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 5), (2, 1), (2, 2), (3, 1), (None, 6)], key=str)


@pytest.mark.parametrize("bound", [0, 5_000_000])
def test_merge_tail_on_both_sides_of_the_bound(spark, monkeypatch, bound):
    monkeypatch.setattr(jobs, "TAIL_KEYS_BROADCAST_MAX", bound)
    monkeypatch.setattr(jobs, "latest_changes", lambda df: df.groupBy("key").agg(F.max("v").alias("v")))
    base = spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "key int, v int")
    tail = spark.createDataFrame([(1, 2), (None, 3)], "key int, v int")
    assert sorted(map(tuple, jobs.merge_tail(base, tail).collect()), key=str) == sorted(
        [(1, 2), (2, 1), (None, 3)], key=str)


def test_null_partitions_are_read_before_they_are_overwritten(spark, scratch):
    path = scratch("null-part")
    tables.write_table(spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 1, "a")],
                                             "k int, at int, p string"), path, ["p"])
    tables.upsert_table(spark, path, spark.createDataFrame([(1, 2, None)], "k int, at int, p string"),
                        ["k"], [F.col("at").desc()], ["p"])
    got = spark.read.parquet(path).select("k", "at").collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 1), (3, 1)]
    tables.update_table(spark, path, F.col("k") == 2, {"at": 9}, ["p"])
    assert spark.read.parquet(path).where("k = 2").first()["at"] == 9


def test_null_foreign_keys(spark):
    child = spark.createDataFrame([(None,), (1,), (7,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert orphan_keys(child, "fk", parent, "pk").count() == 1
    assert reports.fk_orphans({"x": (child, "fk", parent, "pk")}).first()["violations"] == 2


def test_reports_are_ordered(spark):
    from ledgerline.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    n = [r["order_count"] for r in QUERIES["orders_by_status"](spark, sf).collect()]
    v = [r["lifetime_value"] for r in QUERIES["revenue_by_customer"](spark, sf).collect()]
    assert n == sorted(n, reverse=True) and v == sorted(v, reverse=True)
    for key, col in (("row_counts", "tbl"), ("latest_update", "table_name")):
        names = [r[col] for r in QUERIES[key](spark, sf).collect()]
        assert names == sorted(names)


def test_interrupted_snapshot_is_not_read(spark, scratch):
    root = scratch("cdc")
    spark.range(3).withColumn("_batch_id", F.lit(0)).write.partitionBy("_batch_id").parquet(f"{root}/log")
    spark.range(1).write.parquet(f"{root}/snapshot/upto=0")
    assert jobs._snapshots(spark, root) == [0]
    fs, p = __import__("ledgerline.session", fromlist=["_fs_path"])._fs_path(
        spark, f"{root}/snapshot/upto=0/_SUCCESS")
    fs.delete(p, False)
    assert jobs._snapshots(spark, root) == []


LOAD = """
import datetime as dt, sys
sys.path.insert(0, {root!r})
from ledgerline.session import build_session
from ledgerline.sources.extract import SourceSpec, extract
spark = build_session("local[1]", shuffle_partitions=1)
df = spark.sql("select id, timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, int(id)) as updated_at from range(20)")
spec = SourceSpec("t", "updated_at", ["id"])
wm = df.where("id < 10").agg({{"updated_at": "max"}}).first()[0]
print("LOADED", sorted(r.id for r in extract(df, spec, wm).collect()))
"""


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_watermark_holds_under_any_driver_clock(zone):
    out = subprocess.run([sys.executable, "-c", LOAD.format(root=ROOT)], env=os.environ | {"TZ": zone},
                         capture_output=True, text=True, timeout=180)
    assert f"LOADED {list(range(10, 20))}" in out.stdout, out.stderr[-2000:]
