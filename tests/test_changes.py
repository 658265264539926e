"""Change streams of several tables."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.streaming.changes import ChangeLog, ChangeTable, read_change_files

NOW = {"availableNow": True}
A = ChangeTable("a", ("x", "y"), T.StructType([
    T.StructField("x", T.LongType()), T.StructField("y", T.StringType()), T.StructField("v", T.DecimalType(10, 2)),
    T.StructField("d", T.DateType()), T.StructField("o'k", T.BooleanType())]))
B = ChangeTable("b", ("id",), T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.StructType([
    T.StructField("m", T.ArrayType(T.LongType()))]))]))


def rec(table, seq, day, op, key, after=None, before=None):
    return json.dumps({"table": table, "seq": seq, "ts": f"2024-01-{day:02d} 00:00:00", "op": op, "key": key,
                       "before": before, "after": after})


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_all_columns_of_several_tables(spark, scratch):
    log = ChangeLog(spark, scratch("changes"), (A, B))
    assert log.records().count() == 0 and log.state("a").count() == 0 and log.drift().count() == 0
    log.write_batch(frame(spark, [
        rec("a", 1, 1, "c", {"x": 1, "y": "p"}, {"x": 1, "y": "p", "v": 1.5, "d": "2024-01-01", "o'k": True}),
        rec("a", 2, 2, "u", {"x": "1", "y": "p"}, {"x": 1, "y": "p", "v": "2.25", "d": None, "extra": [1]}),
        rec("a", 3, 1, "c", {"y": None, "x": 2}, {"x": 2, "v": "no"}),
        rec("a", 9, 1, "c", None, {"x": 3, "y": "q", "v": 3}),
        rec("b", 1, 1, "r", {"id": 1}, {"id": 1, "n": {"m": [1, 2]}}),
        rec("c", 1, 1, "c", {"z": 1}, {"z": 1}),
        "broken", "[1]", "", "{}"]), 0)
    assert rows(log.state("a").select("x", "y", "v", "d", "`o'k`", "op", "seq")) == [
        (1, "p", 2.25, None, None, "u", 2), (2, None, None, None, None, "c", 3), (3, "q", 3, None, None, "c", 9)]
    assert rows(log.state("b").select("id", "n.m")) == [(1, [1, 2])]
    assert sorted(r.value for r in log.rejected().collect()) == ["", "[1]", "broken", "{}"]
    got = {(r.table_name, r.field, r.problem): (r.seen_type, r.n_records) for r in log.drift().collect()}
    assert got == {("a", "extra", "added"): ("ARRAY<BIGINT>", 1), ("c", None, "table"): (None, 1),
                   ("a", "y", "missing"): (None, 1), ("a", "d", "missing"): (None, 2),
                   ("a", "o'k", "missing"): (None, 3), ("a", "v", "type"): ("STRING", 1)}
    # a replayed batch replaces itself, a later one deletes
    log.write_batch(frame(spark, [rec("b", 1, 1, "r", {"id": 1}, {"id": 1})]), 0)
    log.write_batch(frame(spark, [rec("b", 2, 3, "d", {"id": 1}, None, {"id": 1})]), 1)
    assert log.state("b").count() == 0 and log.state_as_of("b", "2024-01-02 00:00:00").count() == 1


def brute(records, at=99):
    state = {}
    for table, seq, day, op, key, val in sorted(records, key=lambda r: (r[2], r[1])):
        if day <= at:
            state[key] = None if op == "d" else val
    return sorted(((k, v) for k, v in state.items() if v is not None), key=str)


def test_random_batches_compaction_and_replay_in_time(spark, scratch):
    rnd = random.Random(6)
    records, seq = [], 0
    for _ in range(120):
        seq += 1
        records.append(("b", seq, rnd.randrange(1, 29), rnd.choice("cuud"), rnd.randrange(12), rnd.randrange(1000)))
    b = ChangeTable("b", ("id",), T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())]))
    log = ChangeLog(spark, scratch("changes"), (b,))
    lines = [rec(t, s, d, op, {"id": k}, None if op == "d" else {"id": k, "v": v}) for t, s, d, op, k, v in records]
    order = list(range(120))
    rnd.shuffle(order)
    done = []
    for batch in range(4):
        part = order[batch * 30:batch * 30 + 30]
        done += part
        log.write_batch(frame(spark, [lines[i] for i in part] * 2), batch)
        if batch in (1, 2):
            assert log.compact("b") == batch == log.compact("b")
        assert rows(log.state("b").select("id", "v")) == brute([records[i] for i in done])
        for at in (1, 9, 20):
            got = log.state_as_of("b", f"2024-01-{at:02d} 00:00:00").select("id", "v")
            assert rows(got) == brute([records[i] for i in done], at)
    with pytest.raises(ValueError):
        log.expire("b", 3)
    assert log.expire("b", 2) == 3 and log.expire("b", 2) == 0
    assert rows(log.state("b").select("id", "v")) == brute(records)
    with pytest.raises(ValueError, match="expired"):
        log.state_as_of("b", "2024-01-02 00:00:00")


def test_stream_runs_pick_up_where_they_stopped(spark, scratch):
    root = scratch("changes")
    log = ChangeLog(spark, root, (A, B))
    for day in (1, 2):
        frame(spark, [rec("b", day, day, "u", {"id": 1}, {"id": 1, "n": {"m": [day]}})]) \
            .write.mode("append").text(f"{root}/in")
        log.stream(read_change_files(spark, f"{root}/in", 1), f"{root}/ck", NOW).awaitTermination()
    assert log.records("b").count() == 2
    assert [r.n.m for r in log.state("b").collect()] == [[2]]
    plan = log.records("b")._jdf.queryExecution().executedPlan().toString()
    assert "table_name" in plan.split("PartitionFilters")[1].split("]")[0]
    assert log.records("b").select(F.input_file_name()).distinct().count() == 2
