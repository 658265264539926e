"""Randomised checks against plain-Python models (few examples: each one
runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.dedup import dedup_latest
from ledgerline.operators.ordered import neighbours

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3),                      # key (few keys -> hot groups)
              st.one_of(st.none(), st.integers(0, 20)),  # updated (None allowed)
              st.integers(0, 1000)),                    # tie-break
    min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_strategy)
def test_dedup_latest_matches_python(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(k, None if u is None else base + dt.timedelta(days=u), t, i) for i, (k, u, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, u timestamp_ntz, t int, i int")
    got = {r.k: r.i for r in dedup_latest(df, ["k"], [F.col("u").desc_nulls_first(), F.col("t").desc(),
                                                      F.col("i").asc()]).collect()}

    def rank(r):  # NULL first, then latest u, then highest t, then lowest i
        return (0 if r[1] is None else 1, -(r[1] - base).days if r[1] is not None else 0, -r[2], r[3])

    want = {}
    for r in sorted(data, key=rank):
        want.setdefault(r[0], r[3])
    assert got == want


@SETTINGS
@given(ts=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 10_000)), min_size=2, max_size=80,
                   unique_by=lambda x: x))
def test_neighbours_split_matches_python(spark, ts):
    df = spark.createDataFrame([(k, t, t % 3) for k, t in ts], "k int, t int, c int")
    got = {(r.k, r.t): (r._next, r._is_first, r._prev_c)
           for r in neighbours(df, ["k"], "t", ["c"], hot_rows=2).collect()}
    want = {}
    for k in {k for k, _ in ts}:
        seq = sorted(t for kk, t in ts if kk == k)
        for j, t in enumerate(seq):
            want[(k, t)] = (seq[j + 1] if j + 1 < len(seq) else None, j == 0,
                            seq[j - 1] % 3 if j > 0 else None)
    assert got == want
