"""Partition rewrites: emptied partitions, NULL partitions, keys that move."""

from pyspark.sql import functions as F

from ledgerline.operators import tables
from ledgerline.plans import incremental

ROWS = "k int, v string, at int, p string"


def _table(spark, path, rows):
    tables.write_table(spark.createDataFrame(rows, ROWS), path, ["p"])


def _rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select("k", "v", "at", "p").collect()), key=str)


def test_delete_empties_whole_and_null_partitions(spark, scratch):
    path = scratch("emptied")
    _table(spark, path, [(1, "a", 1, "m 1:x%"), (2, "b", 1, "m 1:x%"), (3, "c", 1, None), (4, "d", 1, "m2"),
                         (None, "e", 1, "m2"), (5, "f", 1, "m3")])
    tables.delete_missing_table(spark, path, spark.createDataFrame([(4,), (5,)], "k int"), ["k"], ["p"])
    assert _rows(spark, path) == [(4, "d", 1, "m2"), (5, "f", 1, "m3")]
    # every partition emptied: no rows, the schema still readable, new rows welcome
    tables.delete_missing_table(spark, path, spark.createDataFrame([], "k int"), ["k"], ["p"])
    assert _rows(spark, path) == []
    tables.upsert_table(spark, path, spark.createDataFrame([(1, "n", 2, "m2")], ROWS), ["k"], [F.desc("at")], ["p"])
    assert _rows(spark, path) == [(1, "n", 2, "m2")]


def test_delete_keeps_null_key_of_the_snapshot(spark, scratch):
    path = scratch("null-key")
    _table(spark, path, [(None, "e", 1, "m1"), (1, "a", 1, "m1")])
    tables.delete_missing_table(spark, path, spark.createDataFrame([(None,)], "k int"), ["k"], ["p"])
    assert _rows(spark, path) == [(None, "e", 1, "m1")]


def test_upsert_moves_a_key_between_partitions(spark, scratch):
    path = scratch("moved")
    _table(spark, path, [(1, "a", 1, "m1"), (2, "b", 1, None), (3, "c", 5, "m2"), (4, "d", 1, "m2")])
    batch = [(1, "a2", 2, "m3"), (2, "b2", 2, "m1"), (3, "old", 1, "m1")]
    tables.upsert_table(spark, path, spark.createDataFrame(batch, ROWS), ["k"], [F.desc("at")], ["p"])
    assert _rows(spark, path) == [(1, "a2", 2, "m3"), (2, "b2", 2, "m1"), (3, "c", 5, "m2"), (4, "d", 1, "m2")]


def test_update_of_the_partition_column_moves_rows(spark, scratch):
    path = scratch("update")
    _table(spark, path, [(1, "a", 1, "m1"), (2, "b", 1, "m2")])
    tables.update_table(spark, path, F.col("k") == 1, {"p": "m2"}, ["p"])
    assert _rows(spark, path) == [(1, "a", 1, "m2"), (2, "b", 1, "m2")]


def test_backfill_empties_months_and_keeps_moved_orders_out(spark, scratch):
    path = scratch("backfill")
    cols = "order_id string, customer_id string, order_total decimal(18,2), tax_amount decimal(18,2), " \
           "created_at timestamp_ntz, updated_at timestamp_ntz, _extracted_at timestamp_ntz, external_id string, " \
           "email string, full_name string, phone string, segment string, country_code string, city string, " \
           "is_active boolean"
    raw = spark.sql("""SELECT o AS order_id, 'c' AS customer_id, 10.00BD AS order_total, 1.00BD AS tax_amount,
        CAST(c AS timestamp_ntz) AS created_at, CAST(u AS timestamp_ntz) AS updated_at,
        CAST(u AS timestamp_ntz) AS _extracted_at
        FROM VALUES ('a', '2024-01-05', '2024-01-05'), ('b', '2024-02-05', '2024-02-05'),
                    ('b', '2024-03-05', '2024-03-09'), ('d', '2024-03-01', '2024-03-01') AS t(o, c, u)""")
    customers = spark.createDataFrame([], cols)
    # published before the later version of b came
    early = raw.where("updated_at < timestamp_ntz'2024-03-05'")
    incremental.run_incremental(spark, path, early, customers)
    incremental.backfill(spark, path, raw, customers, "2024-02-01", "2024-02-01")
    months = lambda: {(r.order_id, str(r.created_month)) for r in spark.read.parquet(path).collect()}
    assert months() == {("a", "2024-01-01"), ("d", "2024-03-01")}
    incremental.backfill(spark, path, raw, customers, "2024-03-01", "2024-03-01")
    assert months() == {("a", "2024-01-01"), ("b", "2024-03-01"), ("d", "2024-03-01")}
