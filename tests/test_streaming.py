"""Structured Streaming jobs: availableNow runs, replays, independent
consumers."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.session import local_path
from ledgerline.sources import testdata as td
from ledgerline.streaming import jobs
from ledgerline.streaming.dedup import DedupSink

NOW = {"availableNow": True}
EVENTS = f"{SF_SMALL}/events.parquet"


def _copy_events(dst_dir, name):
    os.makedirs(local_path(dst_dir), exist_ok=True)
    shutil.copy(EVENTS, os.path.join(local_path(dst_dir), name))


def test_land_then_apply_in_micro_batches(spark, scratch):
    """Files arrive over time; every run of the stream picks up only the
    new file, and the current state equals the batch computation."""
    root = scratch("cdc")
    inbox = f"{root}/inbox"
    _copy_events(inbox, "part-0.parquet")
    schema = spark.read.parquet(EVENTS).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(inbox)
    changes = jobs.events_to_changes(src)
    q = jobs.apply_changes(changes, f"{root}/log", f"{root}/_ck", NOW)
    q.awaitTermination()
    # a second delivery of the same events, as a new file
    _copy_events(inbox, "part-1.parquet")
    q = jobs.apply_changes(changes, f"{root}/log", f"{root}/_ck", NOW)
    q.awaitTermination()
    log = spark.read.parquet(f"{root}/log")
    assert log.select("_batch_id").distinct().count() == 2
    state = jobs.current_state(log)
    expected = jobs.current_state(td.change_events(spark, SF_SMALL))
    assert sorted(state.collect()) == sorted(expected.collect())


def test_replayed_batch_replaces_itself(spark, scratch):
    root = scratch("cdc")
    changes = td.change_events(spark, SF_SMALL)
    jobs.write_change_batch(changes, 7, f"{root}/log")
    jobs.write_change_batch(changes, 7, f"{root}/log")
    n = spark.read.parquet(f"{root}/log").count()
    assert n == changes.select("key").distinct().count()


def test_independent_consumers_have_own_checkpoints(spark, scratch):
    root = scratch("fanout")
    a = jobs.sink_parquet(jobs.read_stream(spark, EVENTS), f"{root}/a", f"{root}/_ck_a", NOW)
    b = jobs.sink_parquet(jobs.read_stream(spark, EVENTS).where(F.col("event_type") == "error"),
                          f"{root}/b", f"{root}/_ck_b", NOW)
    a.awaitTermination()
    b.awaitTermination()
    ev = spark.read.parquet(EVENTS)
    assert spark.read.parquet(f"{root}/a").count() == ev.count()
    assert spark.read.parquet(f"{root}/b").count() == ev.where("event_type = 'error'").count()
    # restarting a consumer from its checkpoint adds nothing
    a2 = jobs.sink_parquet(jobs.read_stream(spark, EVENTS), f"{root}/a", f"{root}/_ck_a", NOW)
    a2.awaitTermination()
    assert spark.read.parquet(f"{root}/a").count() == ev.count()


def test_land_changes_stamps_rows(spark, scratch):
    root = scratch("land")
    q = jobs.land_changes(jobs.read_stream(spark, EVENTS), f"{root}/raw", f"{root}/_ck", NOW)
    q.awaitTermination()
    raw = spark.read.parquet(f"{root}/raw")
    assert "_landed_at" in raw.columns and raw.count() == spark.read.parquet(EVENTS).count()


def test_windowed_counts_match_batch(spark, scratch):
    root = scratch("counts")
    q = jobs.emit_counts(jobs.windowed_counts(jobs.read_stream(spark, EVENTS)), f"{root}/log",
                         f"{root}/_ck", NOW)
    q.awaitTermination()
    got = jobs.current_counts(spark.read.parquet(f"{root}/log"))
    ev = spark.read.parquet(EVENTS)
    want = ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"),
                      "event_type").count()
    assert got.count() == want.count()
    assert got.agg(F.sum("event_count")).first()[0] == ev.count()


def test_compaction_keeps_the_state(spark, scratch):
    root = scratch("cdc")
    changes = td.change_events(spark, SF_SMALL)
    a = changes.where("seq % 2 = 0")
    b = changes.where("seq % 2 = 1")
    jobs.write_change_batch(a, 0, f"{root}/log")
    assert jobs.compact(spark, root) == 0
    jobs.write_change_batch(b, 1, f"{root}/log")
    expected = sorted(jobs.current_state(changes).collect())
    assert sorted(jobs.state_view(spark, root).collect()) == expected
    assert jobs.compact(spark, root) == 1
    assert sorted(jobs.state_view(spark, root).collect()) == expected
    assert jobs.compact(spark, root) == 1  # nothing new


def test_variant_flattening_matches_json_schema(spark):
    from ledgerline.streaming.cdc import flatten_events, flatten_events_variant
    ev = spark.read.parquet(EVENTS)
    assert sorted(flatten_events_variant(ev).collect()) == sorted(flatten_events(ev).collect())


def test_sink_dedup_across_batches_and_replays(spark, scratch):
    sink = DedupSink(spark, scratch("dedup"), buckets=4)
    ev = spark.read.parquet(EVENTS)
    sink.write_batch(ev.unionByName(ev), 0)
    # a later batch repeating half the events adds nothing for those
    sink.write_batch(ev.where("event_id % 2 = 0"), 1)
    # replay of batch 0 replaces its own rows
    sink.write_batch(ev.unionByName(ev), 0)
    out = sink.read()
    assert out.count() == ev.count() == out.select("event_id").distinct().count()
    with pytest.raises(ValueError):
        DedupSink(spark, sink.root, buckets=8).known(ev.select(F.col("event_id").alias("id")), 9)


def test_dedup_keeps_nameless_and_drops_copies_of_any_age(spark, scratch):
    import datetime as dt
    import random
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(3)
    sink = DedupSink(spark, scratch("dedup"), "i", "t", buckets=3)
    seen, want, batches = set(), [], []
    for b in range(9):
        rows = [(rnd.choice([None, *range(200)]), t0 + dt.timedelta(days=rnd.randrange(400)) if rnd.random() < .9 else None,
                 100 * b + j) for j in range(40)]
        best = {}
        for i, t, v in rows:
            if i is None:
                want.append((i, t, v))
            elif i not in seen:
                best.setdefault(i, []).append((t is None, t or t0, t, v))
        batches.append(spark.createDataFrame(rows, "i int, t timestamp_ntz, v int"))
        sink.write_batch(batches[-1], b)
        if b in (1, 2, 5, 6, 7):
            sink.compact()
        if b == 6:                      # delivered again after its ids went into a run
            sink.write_batch(batches[b], b)
        for i, c in best.items():       # times are distinct but for missing ones
            least = min(x[:2] for x in c)
            want.append((i, {(x[2], x[3]) for x in c if x[:2] == least}))
        seen |= set(best)
    got = [tuple(r) for r in sink.read().collect()]
    assert len(got) == len(want)
    ids = {r[0]: r[1:] for r in got if r[0] is not None}
    for w in want:
        if w[0] is None:
            assert w in got
        else:
            assert ids[w[0]] in w[1]
    runs = sink.runs()
    assert runs[0][0] == 0 and runs[-1][1] == 7 and len(runs) <= 3
    assert all(a[1] + 1 == b[0] for a, b in zip(runs, runs[1:]))


def test_few_ids_read_only_what_the_filters_leave(spark, scratch):
    """Ids that no run holds: its Bloom filters leave no row to read, though
    they lie between the smallest and the largest."""
    sink = DedupSink(spark, scratch("dedup"), buckets=2)
    ev = spark.range(20_000).select((F.col("id") * 2).alias("event_id"), F.lit(None).cast("timestamp_ntz").alias("ts"))
    sink.write_batch(ev, 0)
    sink.compact()
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from ledgerline.streaming.dedup import pushed_values
        def scanned(ids):
            with pushed_values(spark, 200):
                df = sink._within(sink._run((0, 0)), None, ids, True)
                df.collect()
                leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
                return leaf.metrics().apply("numOutputRows").value()
        assert scanned([10, 20_000]) >= 10_000          # both buckets' files or one, whole row groups
        assert scanned([11, 1001, 20_001]) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_windowed_counts_keep_late_events(spark, scratch):
    root = scratch("late")
    ev = spark.read.parquet(EVENTS)
    cut = ev.agg(F.percentile_approx(F.col("ts").cast("timestamp").cast("double"), [0.33, 0.66]).alias("q")).first()["q"]
    at = F.col("ts").cast("timestamp").cast("double")
    parts = [ev.where(at > cut[1]), ev.where((at > cut[0]) & (at <= cut[1])), ev.where(at <= cut[0])]
    for part in parts:           # newest events first
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
        jobs.emit_counts(jobs.windowed_counts(jobs.read_stream(spark, f"{root}/in")), f"{root}/log",
                         f"{root}/_ck", NOW).awaitTermination()
    got = jobs.current_counts(spark.read.parquet(f"{root}/log"))
    want = ev.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").count()
    assert sorted(got.select("window_start", "event_type", "event_count").collect()) == sorted(want.collect())
