"""Behavioural properties of the operators (checked on the driver's test
data and on small frames built inside the tests)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.functions import columns as fn
from ledgerline.operators import history, quality, tables
from ledgerline.operators.dedup import dedup_latest
from ledgerline.plans import incremental, marts, staging
from ledgerline.sources import testdata as td
from ledgerline.sources.extract import SourceSpec
from ledgerline.sources.loader import IncrementalLoader


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_staging_keys_unique_and_rank_is_one(spark):
    stg = staging.stg_orders(td.raw_orders(spark, SF_SMALL))
    agg = stg.agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("k"),
                  F.max("_row_num").alias("mx"), F.min("_row_num").alias("mn")).first()
    assert agg.n == agg.k and agg.mx == 1 and agg.mn == 1


def test_dedup_prefers_null_updated_at_like_desc_in_postgres(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), "a"), (1, None, "b"), (2, dt.datetime(2024, 1, 2), "c"),
         (2, dt.datetime(2024, 1, 3), "d")], "k int, updated_at timestamp_ntz, v string")
    out = dedup_latest(df, ["k"], [fn.nulls_first_desc("updated_at")])
    assert {r.k: r.v for r in out.collect()} == {1: "b", 2: "d"}


def test_fact_join_is_removed_from_plan(spark):
    fct = marts.fct_orders(staging.stg_orders(td.raw_orders(spark, SF_SMALL)),
                           staging.stg_customers(td.raw_customers(spark, SF_SMALL)))
    plan = fct._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "Join" not in plan
    assert "WindowGroupLimit" in plan


def test_filters_reach_the_scan(spark):
    spec = SourceSpec("orders")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    from ledgerline.sources.extract import extract_since
    df = extract_since(o, SourceSpec("orders", "o_orderdate"), dt.datetime(1998, 1, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    assert spec.mode == "gt"


def test_incremental_equals_full_rebuild(spark, scratch):
    path = scratch("fct")
    raw_o, raw_c = td.raw_orders(spark, SF_SMALL), td.raw_customers(spark, SF_SMALL)
    first = raw_o.where(F.col("_extracted_at") <= F.lit(td.ORDERS_V0_EXTRACTED_AT).cast("timestamp_ntz"))
    assert incremental.run_incremental(spark, path, first, raw_c) == "full"
    assert incremental.run_incremental(spark, path, raw_o, raw_c) == "incremental"
    # a third run finds nothing new and changes nothing
    incremental.run_incremental(spark, path, raw_o, raw_c)
    full = marts.fct_orders(staging.stg_orders(raw_o), staging.stg_customers(raw_c))
    assert _set(incremental.read_fact(spark, path)) == _set(full)


def test_reloading_a_batch_does_not_change_staging(spark, scratch):
    loader = IncrementalLoader(spark, scratch("ingest"))
    spec = SourceSpec("orders", "updated_at", ("order_id",), mode="ge")
    src = td.source_orders(spark, SF_SMALL)
    loader.load(spec, src, extracted_at=td.LOAD_RUN1_AT, interval_start="1990-01-01")
    once = staging.stg_orders(loader.read_raw("orders")).drop("_extracted_at")
    before = _set(once)
    loader.load(spec, src, extracted_at=td.LOAD_RUN2_AT, interval_start="1990-01-01")
    assert loader.read_raw("orders").count() == 2 * src.count()
    assert _set(staging.stg_orders(loader.read_raw("orders")).drop("_extracted_at")) == before


def test_empty_batch_leaves_watermark(spark, scratch):
    loader = IncrementalLoader(spark, scratch("ingest"))
    spec = SourceSpec("orders")
    src = td.source_orders(spark, SF_SMALL)
    r1 = loader.load(spec, src, extracted_at=td.LOAD_RUN1_AT)
    r2 = loader.load(spec, src, extracted_at=td.LOAD_RUN2_AT)
    assert r1.committed and r1.load_mode == "full"
    assert not r2.committed and r2.row_count == 0 and r2.load_mode == "incremental"
    st = loader.state().first()
    assert st.batch_id == 1 and st.row_count == src.count()
    assert [r.status for r in loader.audit().orderBy("batch_id").collect()] == ["loaded", "empty"]


def test_scd2_ranges_do_not_overlap(spark):
    h = history.scd2_timestamp(td.raw_customers(spark, SF_SMALL), ["customer_id"], "updated_at",
                               ["segment"])
    bad = h.alias("a").join(h.alias("b"), "customer_id").where(
        (F.col("a.valid_from") < F.col("b.valid_from")) &
        (F.coalesce(F.col("a.valid_to"), F.lit(dt.datetime(9999, 1, 1))) > F.col("b.valid_from")))
    assert bad.count() == 0
    cur = h.where("is_current").groupBy("customer_id").count()
    assert cur.where("count <> 1").count() == 0
    assert cur.count() == h.select("customer_id").distinct().count()


def test_scd2_merge_matches_rebuild(spark):
    raw = td.raw_customers(spark, SF_SMALL)
    cols = ["segment", "email"]
    base = history.scd2_timestamp(raw.where("ver = 0"), ["customer_id"], "updated_at", cols)
    merged = history.scd2_merge(base, raw.where("ver = 1"), ["customer_id"], "updated_at", cols)
    rebuilt = history.scd2_timestamp(raw, ["customer_id"], "updated_at", cols)
    assert _set(merged) == _set(rebuilt)
    # replaying the same changes is a no-op
    assert _set(history.scd2_merge(merged, raw.where("ver = 1"), ["customer_id"], "updated_at", cols)) \
        == _set(rebuilt)


def test_quality_gate_blocks_on_failure(spark):
    raw = td.raw_orders(spark, SF_SMALL)
    summary = quality.suite_summary([quality.TableChecks(
        "raw.orders", raw, row_checks=[quality.not_null("order_id")], unique=[["order_id"]])])
    with pytest.raises(quality.QualityGateError):
        quality.gate(summary)
    fct = marts.fct_orders(staging.stg_orders(raw), staging.stg_customers(td.raw_customers(spark, SF_SMALL)))
    ok = quality.suite_summary([quality.TableChecks(
        "fct_orders", fct, row_checks=[quality.not_null("order_id")], unique=[["order_id"]])])
    quality.gate(ok)


def test_expression_check_lets_null_pass(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, x int")
    out = quality.row_check_counts(df, "t", [quality.expression_is_true("x_ge_0", "x >= 0"),
                                             quality.accepted_values("x", ["5"])]).collect()
    assert {r.check_name: r.failing_rows for r in out} == {"x_ge_0": 1, "accepted_values_x": 1}


def test_strict_uuid_cast_raises_and_lenient_nulls(spark):
    df = spark.createDataFrame([("not-a-uuid",), ("A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11",)], "u string")
    got = [r[0] for r in df.select(fn.cast_uuid("u", strict=False)).collect()]
    assert got == [None, "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"]
    with pytest.raises(Exception):
        df.select(fn.cast_uuid("u", strict=True)).collect()


def test_varchar_truncates_and_char_pads(spark):
    df = spark.createDataFrame([("USA", "x")], "a string, b string")
    r = df.select(fn.varchar("a", 2).alias("v"), fn.char("b", 2).alias("c")).first()
    assert r.v == "US" and r.c == "x "


def test_line_total_uses_decimal_discount(spark):
    df = spark.createDataFrame([(3, Decimal("19.9900"), Decimal("0.15"))],
                               "q int, p decimal(18,4), d decimal(5,2)")
    v = df.select(F.round(F.col("q") * F.col("p") * (F.lit(1) - F.col("d")), 2).cast("decimal(18,2)")).first()[0]
    assert v == Decimal("50.97")


def test_assign_identity_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    out = tables.assign_identity(df, "new_id", 100, ["k"]).collect()
    pairs = sorted((r.k, r.new_id) for r in out)
    assert [p[1] for p in pairs] == list(range(101, 1101))


def test_insert_ignore_keeps_existing_rows(spark, scratch):
    path = scratch("t")
    tables.write_table(spark.createDataFrame([(1, "old")], "k int, v string"), path)
    batch = spark.createDataFrame([(1, "new"), (2, "b1"), (2, "b0")], "k int, v string")
    tables.insert_ignore_table(spark, path, batch, ["k"], [F.col("v").asc()])
    assert _set(spark.read.parquet(path)) == [(1, "old"), (2, "b0")]


def test_upsert_rewrites_only_touched_partitions(spark, scratch):
    path = scratch("t")
    tables.write_table(spark.createDataFrame(
        [(1, "a", 1, "m1"), (2, "b", 1, "m2")], "k int, v string, ts int, p string"), path, ["p"])
    import glob
    import os
    from ledgerline.session import local_path
    m2_files = sorted(glob.glob(os.path.join(local_path(path), "p=m2", "*.parquet")))
    tables.upsert_table(spark, path, spark.createDataFrame([(1, "a2", 2, "m1"), (3, "c", 1, "m1")],
                                                           "k int, v string, ts int, p string"),
                        ["k"], [F.col("ts").desc()], ["p"])
    assert sorted(glob.glob(os.path.join(local_path(path), "p=m2", "*.parquet"))) == m2_files
    assert _set(spark.read.parquet(path).select("k", "v", "p")) == [(1, "a2", "m1"), (2, "b", "m2"),
                                                                   (3, "c", "m1")]


def test_update_where_touches_timestamp(spark):
    df = spark.createDataFrame([(1, "processing", dt.datetime(2020, 1, 1)), (2, "delivered", dt.datetime(2020, 1, 1))],
                               "id int, status string, updated_at timestamp_ntz")
    out = tables.update_where(df, F.col("status") == "processing", {"status": "shipped"},
                              touch=("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    got = {r.id: (r.status, r.updated_at) for r in out.collect()}
    assert got[1] == ("shipped", dt.datetime(2024, 1, 1)) and got[2] == ("delivered", dt.datetime(2020, 1, 1))


def test_surrogate_key_null_sentinel_and_safe_divide(spark):
    df = spark.createDataFrame([(None, 1, 0.0), ("a", None, 2.0)], "a string, b int, d double")
    r = df.select(fn.surrogate_key("a", "b").alias("sk"), fn.safe_divide("d", "d").alias("q")).collect()
    import hashlib
    assert r[0].sk == hashlib.md5(b"__null__-1").hexdigest() and r[0].q is None
    assert r[1].sk == hashlib.md5(b"a-__null__").hexdigest() and r[1].q == 1.0


def test_backfill_replaces_only_window(spark, scratch):
    path = scratch("fct")
    raw_o, raw_c = td.raw_orders(spark, SF_SMALL), td.raw_customers(spark, SF_SMALL)
    first = raw_o.where(F.col("_extracted_at") <= F.lit(td.ORDERS_V0_EXTRACTED_AT).cast("timestamp_ntz"))
    incremental.run_incremental(spark, path, first, raw_c)
    stale = _set(incremental.read_fact(spark, path).where("order_month < '1996-01-01'"))
    incremental.backfill(spark, path, raw_o, raw_c, *td.BACKFILL_MONTHS)
    assert _set(incremental.read_fact(spark, path).where("order_month < '1996-01-01'")) == stale


def test_hot_key_split_matches_plain_window(spark):
    """One key holding most rows: the split path (forced with a tiny
    hot_rows bound) gives the same ranges as the plain window."""
    from ledgerline.operators.ordered import neighbours
    ev = td.read(spark, SF_SMALL, "events")
    skewed = ev.select(F.when(F.col("user_id") % 5 != 0, F.lit(0)).otherwise(F.col("user_id")).alias("k"),
                       F.col("ts"), (F.col("event_id") % 3).alias("c"))
    plain = neighbours(skewed, ["k"], "ts", ["c"], hot_rows=10**9)
    split = neighbours(skewed, ["k"], "ts", ["c"], hot_rows=3)
    cols = ["k", "ts", "c", "_next", "_is_first", "_prev_c"]
    assert _set(split.select(*cols)) == _set(plain.select(*cols))
    raw = td.raw_customers(spark, SF_SMALL)
    a = history.scd2_check(raw, ["customer_id"], "updated_at", ["segment"], hot_rows=1)
    b = history.scd2_check(raw, ["customer_id"], "updated_at", ["segment"])
    assert _set(a) == _set(b)


def test_publish_blocks_bad_candidate(spark, scratch):
    path = scratch("fct")
    raw = td.raw_orders(spark, SF_SMALL)
    good = marts.fct_orders(staging.stg_orders(raw), staging.stg_customers(td.raw_customers(spark, SF_SMALL)))

    def checks(df):
        return [quality.TableChecks("fct_orders", df, row_checks=[quality.not_null("order_id")],
                                    unique=[["order_id"]])]

    quality.publish(good, path, checks, run_id="r1")
    published = spark.read.parquet(path).count()
    bad = good.unionByName(good.limit(3))
    with pytest.raises(quality.QualityGateError):
        quality.publish(bad, path, checks, run_id="r2")
    assert spark.read.parquet(path).count() == published


def test_bulk_load_and_helpers(spark, scratch):
    import os
    from ledgerline.session import local_path
    from ledgerline.sources.extract import copy_into, load_seed_csv
    d = scratch("seed")
    os.makedirs(local_path(d), exist_ok=True)
    with open(os.path.join(local_path(d), "methods.csv"), "w") as f:
        f.write("payment_method,fee_rate\ncard,0.0290\ncash,0.0000\n")
    seed = load_seed_csv(spark, d, "payment_method string, fee_rate decimal(5,4)")
    assert seed.count() == 2
    loaded = copy_into(spark, d, "csv", "payment_method string, fee_rate decimal(5,4)",
                       extracted_at="2024-01-01 00:00:00", header="true")
    assert loaded.where("_extracted_at = timestamp_ntz'2024-01-01 00:00:00'").count() == 2
    r = spark.range(2).select(fn.uuid_from_key("id").alias("u"), fn.random_uuid().alias("r"),
                              fn.iso_timestamp(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")).alias("t")).collect()
    assert all(len(x.u) == 36 and len(x.r) == 36 for x in r)
    assert r[0].t == "2024-01-02T03:04:05.000000"


def test_composite_watermark_keeps_rows_tied_with_the_watermark(spark, scratch):
    loader = IncrementalLoader(spark, scratch("ingest"))
    spec = SourceSpec("t", "updated_at", ("id",), mode="gt_key")
    t0 = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([(1, t0), (2, t0)], "id bigint, updated_at timestamp_ntz")
    loader.load(spec, first, extracted_at="2024-01-02 00:00:00")
    # a row committed late with the same timestamp as the watermark
    later = spark.createDataFrame([(1, t0), (2, t0), (3, t0)], "id bigint, updated_at timestamp_ntz")
    r = loader.load(spec, later, extracted_at="2024-01-03 00:00:00")
    assert r.row_count == 1
    assert [x.id for x in loader.read_raw("t").where("_batch_id = 2").collect()] == [3]
    # the strict rule would have lost it
    strict = IncrementalLoader(spark, scratch("ingest"))
    sspec = SourceSpec("t", "updated_at", ("id",))
    strict.load(sspec, first)
    assert strict.load(sspec, later).row_count == 0


def test_deletes_found_by_key_snapshot(spark, scratch):
    path = scratch("t")
    tables.write_table(spark.createDataFrame([(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2")],
                                             "k int, v string, p string"), path, ["p"])
    snapshot = spark.createDataFrame([(1,), (3,)], "k int")
    assert [r.k for r in tables.deleted_keys(spark.read.parquet(path), snapshot, ["k"]).collect()] == [2]
    tables.delete_missing_table(spark, path, snapshot, ["k"], ["p"])
    assert _set(spark.read.parquet(path).select("k", "v")) == [(1, "a"), (3, "c")]


def test_schema_drift_and_ddl(spark, scratch):
    from ledgerline.sources import schemas
    raw = td.raw_orders(spark, SF_SMALL)
    drift = {c: ch for c, ch, _, _ in schemas.schema_drift(raw, schemas.raw_schema(schemas.ORDERS))}
    assert drift["shipping_amount"] == "missing" and drift["ver"] == "unexpected"
    t = schemas.create_table_if_not_exists(spark, "ll_test_orders", schemas.ORDERS, scratch("ddl"),
                                           comment="orders", column_comments={"order_id": "key"})
    assert t.schema["order_id"].metadata.get("comment") == "key"


def test_full_overwrite_drops_stale_partitions_rewrite_keeps_others(spark, scratch):
    path = scratch("t")
    tables.write_table(spark.createDataFrame([(1, "p1"), (2, "p2")], "k int, p string"), path, ["p"])
    tables.write_table(spark.createDataFrame([(3, "p3")], "k int, p string"), path, ["p"])
    assert _set(spark.read.parquet(path)) == [(3, "p3")]
    tables.replace_partitions(spark, path, spark.createDataFrame([(4, "p4")], "k int, p string"), ["p"])
    assert _set(spark.read.parquet(path)) == [(3, "p3"), (4, "p4")]


def test_assign_identity_with_a_hot_order_value(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    ids = [r.new_id for r in tables.assign_identity(df, "new_id", 0, ["k"]).collect()]
    assert sorted(ids) == list(range(1, 3001))


def test_composite_watermark_orders_keys_numerically(spark, scratch):
    loader = IncrementalLoader(spark, scratch("ingest"))
    spec = SourceSpec("t", "updated_at", ("id",), mode="gt_key")
    t0 = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(9, t0), (10, t0)], "id bigint, updated_at timestamp_ntz")
    loader.load(spec, rows)
    assert loader.state().first().watermark_key == "10"
    assert loader.load(spec, rows).row_count == 0


def test_history_table_rewrites_only_changed_buckets(spark, scratch):
    import glob
    import os
    from ledgerline.session import local_path
    path = scratch("hist")
    raw = td.raw_customers(spark, SF_SMALL)
    cols = ["segment", "email"]
    history.scd2_merge_table(spark, path, raw.where("ver = 0"), ["customer_id"], "updated_at", cols, buckets=16)
    before = {d: sorted(glob.glob(os.path.join(d, "*.parquet")))
              for d in glob.glob(os.path.join(local_path(path), "state", "_key_bucket=*"))}
    changes = raw.where("ver = 1 AND customer_id < 20")
    table = history.scd2_merge_table(spark, path, changes, ["customer_id"], "updated_at", cols)
    touched = {r[0] for r in changes.select(history.key_bucket(["customer_id"], 16)).distinct().collect()}
    assert before
    for d, files in before.items():
        b = int(d.rsplit("=", 1)[1])
        assert (sorted(glob.glob(os.path.join(d, "*.parquet"))) == files) == (b not in touched)
    want = history.scd2_timestamp(raw.where("ver = 0").unionByName(changes), ["customer_id"], "updated_at", cols)
    assert _set(table.read().select(*want.columns)) == _set(want)
    # the number of buckets and the other settings are the table's
    for wrong in (dict(buckets=8), dict(columns=["segment"])):
        with pytest.raises(ValueError, match="was made with"):
            history.scd2_merge_table(spark, path, changes, ["customer_id"], "updated_at",
                                     wrong.get("columns", cols), wrong.get("buckets"))
