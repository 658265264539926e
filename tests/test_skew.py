"""Split joins: the same rows as a plain join, heavy keys over many tasks."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.skew import heavy_keys, split_join


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def sides(spark):
    i = F.col("id")
    key = (F.when(i % 3 == 0, 7).when(i % 3 == 1, F.when(i % 2 == 0, None).otherwise(i % 50)).otherwise(i))
    left = spark.range(3000).select(key.alias("k"), (i % 2).alias("g"), i.alias("x"))
    right = spark.range(900).select(F.when(i < 200, 7).when(i < 210, None).otherwise(i % 60).alias("k"),
                                    (i % 2).alias("g"), i.alias("y"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["k"], ["k", "g"]])
@pytest.mark.parametrize("hot_rows", [40, 150, 10**9])
def test_split_join_equals_plain_join(sides, how, on, hot_rows):
    left, right = sides
    if on == ["k"]:
        right = right.withColumnRenamed("g", "h")
    want = left.join(right, on, how)
    got = split_join(left, right, on, how, hot_rows)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


def test_one_row_per_key_on_the_right(sides, spark):
    left, _ = sides
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    for how in ("inner", "left"):
        assert _rows(split_join(left, right, ["k"], how, 100)) == _rows(left.join(right, ["k"], how))


def test_empty_sides(sides):
    left, right = sides
    right = right.drop("g")
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        for how in ("inner", "left", "left_anti"):
            assert _rows(split_join(a, b, ["k"], how, 10)) == _rows(a.join(b, ["k"], how))


def test_a_third_of_all_rows_spreads_over_the_tasks(spark):
    n, parts = 60_000, 16
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("x"))
    right = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("y"))
    assert list(heavy_keys(left, ["k"], 1000).values()) == [pytest.approx(n / 3, rel=0.05)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", str(parts), "-1")):
            spark.conf.set(k, v)
        def largest(df):
            got = df.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
            return len(got), max(r["count"] for r in got)
        assert largest(left.join(right, "k")) == (1, n // 3 + 1)      # id 7 is one more
        tasks, most = largest(split_join(left, right, ["k"], "inner", 200))
        assert tasks == parts and most < 3 * n / 3 / parts
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
