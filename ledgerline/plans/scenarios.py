"""Registered queries that exercise writes: extract + load runs, table
DML, incremental / backfill materialisation, type-2 history.

Each call works in a fresh directory under the shared work dir
(``spark.checkpoint.dir``) and returns a DataFrame read back from the
tables it wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Environment, Target
from ..operators import history, snapshot_diff, tables
from ..operators.dedup import dedup_latest
from ..operators.skew import split_join
from ..operators.versions import colocate
from ..session import scratch_path, work_dir
from ..sources import testdata as td
from ..sources.extract import SourceSpec, extract_full, extract_interval
from ..sources.loader import IncrementalLoader
from ..streaming import jobs
from ..streaming.changes import ChangeLog, ChangeTable, read_change_files
from ..streaming.dedup import DedupSink
from ..streaming.progress import ProgressLog
from . import incremental, reports
from .catalog import register
from .registry import finance_registry

ORDERS = SourceSpec("orders", "updated_at", ("order_id",))
SOURCES = {
    "orders": (ORDERS, td.source_orders),
    "customers": (SourceSpec("customers", "updated_at", ("customer_id",)), td.source_customers),
    "products": (SourceSpec("products", "updated_at", ("product_id",)), td.source_products),
}


def two_run_load(spark, sf_dir) -> IncrementalLoader:
    """Run 1 sees the source as of FIRST_RUN_CUTOFF (full load), run 2 the
    current source (incremental from the committed watermark)."""
    loader = IncrementalLoader(spark, scratch_path(spark, "ingest"))

    def table_job(spec, build):
        def run(ld: IncrementalLoader):
            src = build(spark, sf_dir)
            cutoff = F.lit(td.FIRST_RUN_CUTOFF).cast("timestamp_ntz")
            ld.load(spec, src.where(F.col(spec.incremental_col) <= cutoff), extracted_at=td.LOAD_RUN1_AT)
            ld.load(spec, src, extracted_at=td.LOAD_RUN2_AT)
        return run

    loader.run_tables([table_job(spec, build) for spec, build in SOURCES.values()])
    return loader


@register("extract_full")
def q_extract_full(spark, sf_dir):
    return extract_full(td.source_orders(spark, sf_dir), ORDERS, extracted_at=td.LOAD_RUN1_AT)


@register("extract_incremental_gt")
def q_extract_incremental_gt(spark, sf_dir):
    """The rows run 2 appended: updated_at > the watermark run 1 committed."""
    loader = two_run_load(spark, sf_dir)
    return loader.read_raw("orders").where(F.col("_batch_id") == 2).drop("_batch_id")


@register("extract_interval_ge")
def q_extract_interval_ge(spark, sf_dir):
    return extract_interval(td.source_orders(spark, sf_dir), ORDERS, td.INTERVAL_START,
                            extracted_at=td.LOAD_RUN1_AT)


@register("load_append_overlap")
def q_load_append_overlap(spark, sf_dir):
    """Two inclusive interval loads appended (the second repeats every row
    updated since its start), then deduplicated: the same rows as one
    load from the first start."""
    loader = IncrementalLoader(spark, scratch_path(spark, "overlap"))
    spec = SourceSpec("orders", "updated_at", ("order_id",), mode="ge")
    src = td.source_orders(spark, sf_dir)
    loader.load(spec, src, extracted_at=td.LOAD_RUN1_AT, interval_start=td.OVERLAP_STARTS[0])
    loader.load(spec, src, extracted_at=td.LOAD_RUN2_AT, interval_start=td.OVERLAP_STARTS[1])
    raw = loader.read_raw("orders")
    return dedup_latest(raw, ["order_id"], [F.col("updated_at").desc_nulls_first(),
                                            F.col("_extracted_at").desc_nulls_last()])


@register("watermark_state")
def q_watermark_state(spark, sf_dir):
    return two_run_load(spark, sf_dir).state()


@register("load_audit")
def q_load_audit(spark, sf_dir):
    return two_run_load(spark, sf_dir).audit()


# -- table DML -----------------------------------------------------------------
PAYMENTS_SCHEMA = T.StructType([
    T.StructField("payment_id", T.LongType()), T.StructField("order_id", T.LongType()),
    T.StructField("payment_method", T.StringType()), T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("currency", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])


@register("insert_select")
def q_insert_select(spark, sf_dir):
    """INSERT INTO payments(cols) SELECT ... FROM requests JOIN orders ON
    order_ref: the natural key resolves order id and amount."""
    path = scratch_path(spark, "payments")
    tables.write_table(spark.createDataFrame([], PAYMENTS_SCHEMA), path)
    pay = td.source_payments(spark, sf_dir)
    requests = pay.select("payment_id", F.concat(F.lit("ORD-"), F.lpad(F.col("order_id").cast("string"), 10, "0"))
                          .alias("order_ref"), "payment_method", "status", "created_at")
    orders = td.source_orders(spark, sf_dir).select("order_ref", "order_id",
                                                    F.col("order_total").alias("amount"), "currency")
    tables.append(requests.join(orders, "order_ref"), path, PAYMENTS_SCHEMA)
    return spark.read.parquet(path)


@register("insert_ignore")
def q_insert_ignore(spark, sf_dir):
    """Target: first versions of active customers. Batch: every raw
    customer version. Existing keys are left alone; new keys get their
    earliest version."""
    path = scratch_path(spark, "customers")
    raw = td.raw_customers(spark, sf_dir)
    tables.write_table(raw.where((F.col("ver") == 0) & F.col("is_active")), path)
    tables.insert_ignore_table(spark, path, raw, ["customer_id"],
                               [F.col("updated_at").asc_nulls_last(), F.col("_extracted_at").asc_nulls_last()])
    return spark.read.parquet(path)


ORDER_DEFAULTS = {"status": "pending", "tax_amount": 0, "discount_amount": 0, "currency": "USD"}
ORDER_COLUMNS = ["order_id", "order_ref", "customer_id", "status", "order_total", "tax_amount",
                 "discount_amount", "currency", "created_at", "updated_at"]


@register("insert_defaults")
def q_insert_defaults(spark, sf_dir):
    """Rows arriving without id, status, tax, currency or timestamps get
    the column defaults and new identity values after the table's max."""
    path = scratch_path(spark, "orders")
    raw = td.raw_orders(spark, sf_dir)
    tables.write_table(raw.where(F.col("ver") == 0).select(*ORDER_COLUMNS), path)
    target = spark.read.parquet(path)
    incoming = raw.where(F.col("order_id").isNull()).select("order_ref", "customer_id", "order_total")
    now = F.lit(td.AS_OF).cast("timestamp_ntz")
    filled = tables.with_defaults(incoming, {**ORDER_DEFAULTS, "created_at": now, "updated_at": now})
    start = target.agg(F.max("order_id")).first()[0] or 0
    new_rows = tables.assign_identity(filled, "order_id", start, ["order_ref"])
    tables.append(new_rows, path, target.schema)
    return spark.read.parquet(path)


@register("update_where")
def q_update_where(spark, sf_dir):
    """UPDATE orders SET status = 'shipped' WHERE status = 'processing'; the
    update trigger sets updated_at. Only months holding a matching row are
    rewritten."""
    path = scratch_path(spark, "orders")
    src = td.source_orders(spark, sf_dir).withColumn("created_month", F.trunc(F.to_date("created_at"), "month"))
    tables.write_table(src, path, ["created_month"])
    tables.update_table(spark, path, F.col("status") == "processing", {"status": "shipped"},
                        ["created_month"], touch=("updated_at", F.lit(td.AS_OF).cast("timestamp_ntz")))
    return spark.read.parquet(path).drop("created_month")


@register("upsert_by_key")
def q_upsert_by_key(spark, sf_dir):
    """Target: first extract of every order. Batch: the later versions.
    Latest (updated_at, _extracted_at) per order wins."""
    path = scratch_path(spark, "orders")
    raw = td.raw_orders(spark, sf_dir).where(F.col("order_id").isNotNull()) \
        .withColumn("created_month", F.trunc(F.to_date("created_at"), "month"))
    tables.write_table(raw.where(F.col("ver") == 0), path, ["created_month"])
    tables.upsert_table(spark, path, raw.where(F.col("ver") > 0), ["order_id"],
                        [F.col("updated_at").desc_nulls_first(), F.col("_extracted_at").desc_nulls_last()],
                        ["created_month"])
    return spark.read.parquet(path).drop("created_month")


@register("incremental_model")
def q_incremental_model(spark, sf_dir):
    """Build the fact from the first extract, then run incrementally over
    the whole raw table: equals a full rebuild."""
    path = scratch_path(spark, "fct_orders")
    raw_o, raw_c = td.raw_orders(spark, sf_dir), td.raw_customers(spark, sf_dir)
    first = raw_o.where(F.col("_extracted_at") <= F.lit(td.ORDERS_V0_EXTRACTED_AT).cast("timestamp_ntz"))
    incremental.run_incremental(spark, path, first, raw_c)
    incremental.run_incremental(spark, path, raw_o, raw_c)
    return incremental.read_fact(spark, path)


@register("backfill_partition")
def q_backfill_partition(spark, sf_dir):
    """Fact built from the first extract; the months of BACKFILL_MONTHS are
    then recomputed from the whole raw table. Other months stay stale."""
    path = scratch_path(spark, "fct_orders")
    raw_o, raw_c = td.raw_orders(spark, sf_dir), td.raw_customers(spark, sf_dir)
    first = raw_o.where(F.col("_extracted_at") <= F.lit(td.ORDERS_V0_EXTRACTED_AT).cast("timestamp_ntz"))
    incremental.run_incremental(spark, path, first, raw_c)
    incremental.backfill(spark, path, raw_o, raw_c, *td.BACKFILL_MONTHS)
    return incremental.read_fact(spark, path)


@register("full_refresh_model")
def q_full_refresh_model(spark, sf_dir):
    """The fact built from the first extract, then rebuilt by a full refresh."""
    path = scratch_path(spark, "fct_orders")
    raw_o, raw_c = td.raw_orders(spark, sf_dir), td.raw_customers(spark, sf_dir)
    first = raw_o.where(F.col("_extracted_at") <= F.lit(td.ORDERS_V0_EXTRACTED_AT).cast("timestamp_ntz"))
    incremental.run_incremental(spark, path, first, raw_c)
    incremental.run_incremental(spark, path, raw_o, raw_c, full_refresh=True)
    return incremental.read_fact(spark, path)


def catalog_environment(spark) -> Environment:
    """A target of its own: databases of this call under the work folder."""
    root = scratch_path(spark, "warehouse")
    name = root[-12:]
    return Environment(spark, Target("ci", {x: f"ll_{name}_{x}" for x in ("raw", "staging", "marts")}, threads=4,
                                     query_tag=f"build-{name}", location=root))


ORDERS_BY_DAY = """
SELECT to_date(created_at) AS order_day, count(*) AS orders, CAST(sum(order_total_usd) AS DECIMAL(38,2)) AS total_usd
FROM {fct_orders} GROUP BY to_date(created_at)"""


def built_catalog(spark, sf_dir) -> Environment:
    """Raw tables loaded and shown as permanent views of the raw layer; the
    finance models built from them, twice, into their layers: temp staging
    views, the checked fact as a table swapped by location and clustered by
    day, a report over it as a permanent view."""
    env = catalog_environment(spark)
    loads = {"orders": td.raw_orders, "customers": td.raw_customers}
    for name, build in loads.items():
        path = f"{env.folder('raw')}/{name}"
        with env.tagged(f"load {name}"):
            tables.write_table(build(spark, sf_dir), path)
        env.view_over("raw", name, path, f"all loads of {name}")
    reg = finance_registry(lambda: spark.table(env.target.table("raw", "orders")),
                           lambda: spark.table(env.target.table("raw", "customers")))
    reg.sql_model("orders_by_day", ORDERS_BY_DAY, deps=["fct_orders"], tags=["marts", "finance"])
    for _ in range(2):
        reg.build(spark, tags=["finance"], env=env)
    return env


@register("catalog_fct_orders")
def q_catalog_fct_orders(spark, sf_dir):
    return spark.table(built_catalog(spark, sf_dir).target.table("marts", "fct_orders"))


@register("catalog_orders_by_day")
def q_catalog_orders_by_day(spark, sf_dir):
    return spark.table(built_catalog(spark, sf_dir).target.table("marts", "orders_by_day"))


@register("gate_blocks_publish")
def q_gate_blocks_publish(spark, sf_dir):
    """A good fact is published, then a faulty one is stopped by its checks:
    the failed checks, and the rows of the table that readers still see."""
    from ..operators import quality as q
    from .catalog import build_fct_orders, fct_checks

    env = catalog_environment(spark)
    table = env.versioned("marts", "fct_orders")
    fct = build_fct_orders(spark, sf_dir)
    table.publish(fct, lambda df: [fct_checks(df)])
    broken = td.faulty(fct, "fct_orders").unionByName(fct.where(F.col("order_id").cast("bigint") % 151 == 0))
    failed = []
    try:
        table.publish(broken, lambda df: [fct_checks(df)])
    except q.QualityGateError as e:
        failed = e.failed
    checks = spark.createDataFrame(failed, "check_name string, table_name string, rows bigint")
    kept = spark.table(table.table).where(F.col("order_total_usd") > 0).agg(F.count("*").alias("rows")).select(
        F.lit("published").alias("check_name"), F.lit("fct_orders").alias("table_name"), "rows")
    return checks.unionByName(kept)


@register("seed_values_join")
def q_seed_values_join(spark, sf_dir):
    """Inline reference rows (VALUES) joined to payments on the method
    name. The literal side has a fixed size, so broadcasting it is safe."""
    ref = spark.createDataFrame(
        [(m, p, r) for m, p, r in td.PAYMENT_PROVIDERS],
        "payment_method string, payment_provider string, fee_rate string") \
        .withColumn("fee_rate", F.col("fee_rate").cast("decimal(5,4)"))
    pay = td.source_payments(spark, sf_dir)
    return pay.join(F.broadcast(ref), "payment_method").select(
        "payment_id", "order_id", "payment_method", "payment_provider", "amount",
        (F.col("amount") * F.col("fee_rate")).cast("decimal(18,2)").alias("fee_usd"))


@register("skewed_three_way_join")
def q_skewed_three_way_join(spark, sf_dir):
    """The order line join over lines of which a third are of one product:
    that product's lines are dealt to several tasks."""
    return reports.order_lines_detail(td.skewed_order_items(spark, sf_dir), td.source_orders(spark, sf_dir),
                                      td.source_products(spark, sf_dir), td.SKEW_HOT_ROWS)


@register("snapshot_diff")
def q_snapshot_diff(spark, sf_dir):
    """Keys that differ between two full copies of the orders, and how."""
    work_dir(spark)
    return snapshot_diff.changed_keys(td.orders_snapshot(spark, sf_dir, False), td.orders_snapshot(spark, sf_dir, True),
                                      ["order_id"])


@register("snapshot_diff_apply")
def q_snapshot_diff_apply(spark, sf_dir):
    """Both copies as change records through the change log: the first copy
    read, then the differences; the state equals the second copy."""
    work_dir(spark)
    old, new = (td.orders_snapshot(spark, sf_dir, later) for later in (False, True))
    log = ChangeLog(spark, scratch_path(spark, "diff"), (ORDER_CHANGES,))
    for batch, (before, after, at) in enumerate(((None, old, td.LOAD_RUN1_AT), (old, new, td.LOAD_RUN2_AT))):
        changes = snapshot_diff.snapshot_changes(before, after, ["order_id"])
        log.write_batch(snapshot_diff.change_records(changes, "orders", ["order_id"], td.ts(at)), batch)
    return log.state("orders")


@register("insert_by_email")
def q_insert_by_email(spark, sf_dir):
    """INSERT INTO orders SELECT c.customer_id ... FROM requests JOIN customers
    USING (email): the surrogate id is looked up by the natural key."""
    path = scratch_path(spark, "orders-by-email")
    orders = td.source_orders(spark, sf_dir)
    requests = orders.select("order_ref", F.concat(F.lit("customer"), F.col("customer_id").cast("string"),
                                                   F.lit("@example.com")).alias("email"), "order_total")
    schema = T.StructType([T.StructField("order_ref", T.StringType()), T.StructField("customer_id", T.LongType()),
                           T.StructField("order_total", T.DecimalType(18, 2))])
    tables.write_table(spark.createDataFrame([], schema), path)
    customers = td.source_customers(spark, sf_dir).select("customer_id", "email")
    tables.append(split_join(requests, customers, ["email"]), path, schema)
    return spark.read.parquet(path)


@register("colocated_join")
def q_colocated_join(spark, sf_dir):
    """Order lines and orders written in buckets of the order, then joined
    and summed without a shuffle of either."""
    env = catalog_environment(spark)
    env.ensure_databases()
    for name, build in (("order_items", td.source_order_items), ("orders", td.source_orders)):
        colocate(build(spark, sf_dir), env.target.table("marts", name), ["order_id"], 16,
                 f"{env.folder('marts')}/{name}")
    lines, orders = (spark.table(env.target.table("marts", n)) for n in ("order_items", "orders"))
    return lines.join(orders.select("order_id", "status", "order_total"), "order_id") \
        .groupBy("order_id", "status", "order_total").agg(
            F.count("*").alias("lines"), F.sum("line_total").cast("decimal(28,2)").alias("lines_total"))


# -- history -------------------------------------------------------------------
@register("scd2_timestamp")
def q_scd2_timestamp(spark, sf_dir):
    return history.scd2_timestamp(td.raw_customers(spark, sf_dir), ["customer_id"], "updated_at",
                                  ["segment", "email", "is_active"],
                                  [F.col("_extracted_at").desc_nulls_last()])


@register("scd2_check")
def q_scd2_check(spark, sf_dir):
    return history.scd2_check(td.raw_customers(spark, sf_dir), ["customer_id"], "updated_at",
                              ["segment"], tie_break=[F.col("_extracted_at").desc_nulls_last()])


def order_history(spark, sf_dir, name: str, check_cols: tuple[str, ...]) -> history.HistoryTable:
    table = history.HistoryTable(spark, scratch_path(spark, name), ("order_id",), "updated_at",
                                 ("status", "order_total"), check_cols, ("_extracted_at", "order_ref"), buckets=16)
    for batch in td.order_batches(spark, sf_dir):
        table.apply(batch)
    return table


@register("scd2_incremental")
def q_scd2_incremental(spark, sf_dir):
    """Order versions delivered late, repeated and out of order, spliced into
    a stored history batch by batch: equals the rebuild over all of them."""
    return order_history(spark, sf_dir, "history", ()).read()


@register("scd2_check_incremental")
def q_scd2_check_incremental(spark, sf_dir):
    """The same deliveries under the check strategy (status)."""
    return order_history(spark, sf_dir, "history-check", ("status",)).read()


# -- streaming -------------------------------------------------------------------
AVAILABLE_NOW = {"availableNow": True}


def _events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


@register("cdc_apply")
def q_cdc_apply(spark, sf_dir):
    """Change events streamed through foreachBatch into the change log;
    returns the current state (latest change per key, deletes removed)."""
    root = scratch_path(spark, "cdc")
    changes = jobs.events_to_changes(jobs.read_stream(spark, _events_path(sf_dir)))
    q = jobs.apply_changes(changes, f"{root}/log", f"{root}/_checkpoint", AVAILABLE_NOW)
    q.awaitTermination()
    jobs.compact(spark, root)
    return jobs.state_view(spark, root)


ORDER_CHANGES = ChangeTable("orders", ("order_id",), T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("order_ref", T.StringType()),
    T.StructField("customer_id", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("order_total", T.DecimalType(18, 2)), T.StructField("currency", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
]))
CUSTOMER_CHANGES = ChangeTable("customers", ("customer_id",), T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("external_id", T.StringType()),
    T.StructField("email", T.StringType()), T.StructField("full_name", T.StringType()),
    T.StructField("segment", T.StringType()), T.StructField("is_active", T.BooleanType()),
]))


def streamed_changes(spark, sf_dir) -> ChangeLog:
    """Change records of several tables delivered in three parts, each taken
    by a run of one stream; the logs are compacted after the second."""
    root = scratch_path(spark, "changes")
    log = ChangeLog(spark, root, (ORDER_CHANGES, CUSTOMER_CHANGES))
    records = td.change_records(spark, sf_dir)
    for part in (1, 2, 0):
        records.where(F.col("seq") % 3 == part).select("value").write.mode("append").text(f"{root}/in")
        log.stream(read_change_files(spark, f"{root}/in"), f"{root}/_checkpoint", AVAILABLE_NOW).awaitTermination()
        if part == 2:
            for t in log.tables:
                log.compact(t.name)
    return log


@register("cdc_orders_state")
def q_cdc_orders_state(spark, sf_dir):
    """Current orders out of a stream of several tables' changes: all declared
    columns typed, deletes and late changes applied in order."""
    return streamed_changes(spark, sf_dir).state("orders")


@register("cdc_customers_state")
def q_cdc_customers_state(spark, sf_dir):
    return streamed_changes(spark, sf_dir).state("customers")


@register("cdc_state_as_of")
def q_cdc_state_as_of(spark, sf_dir):
    """Orders as they were at a time, replayed from the retained records."""
    return streamed_changes(spark, sf_dir).state_as_of("orders", td.STATE_AS_OF)


@register("cdc_drift")
def q_cdc_drift(spark, sf_dir):
    """Fields and tables that are not declared, missing or of another type;
    lines that were no records are counted as ``record``."""
    log = streamed_changes(spark, sf_dir)
    none = F.lit(None).cast("string")
    lines = log.rejected().agg(F.count("*").alias("n_records")).select(
        none.alias("table_name"), none.alias("field"), F.lit("record").alias("problem"),
        none.alias("declared_type"), none.alias("seen_type"), "n_records")
    return log.drift().unionByName(lines)


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """The event files delivered twice (two sources over the same files,
    as after a replay), deduplicated by event id on the way into the sink
    (map-side combined per micro-batch, then checked against the ids of all
    earlier batches)."""
    root = scratch_path(spark, "dedup")
    a = jobs.read_stream(spark, _events_path(sf_dir))
    b = jobs.read_stream(spark, _events_path(sf_dir))
    sink = DedupSink(spark, f"{root}/out")
    sink.stream(a.unionByName(b), f"{root}/_checkpoint", AVAILABLE_NOW).awaitTermination()
    return sink.read()


@register("stream_dedup_late")
def q_stream_dedup_late(spark, sf_dir):
    """Events in three deliveries, each run a trigger of its own: later ones
    hold late copies of earlier events, with another time, and events without
    an id. The id index is compacted after the first two."""
    root = scratch_path(spark, "dedup-late")
    sink = DedupSink(spark, f"{root}/out", buckets=16)
    for part, rows in enumerate(td.event_deliveries(spark, sf_dir)):
        rows.write.mode("append").parquet(f"{root}/in")
        sink.stream(jobs.read_stream(spark, f"{root}/in"), f"{root}/_checkpoint", AVAILABLE_NOW).awaitTermination()
        if part < 2:
            sink.compact()
    return sink.read()


@register("events_tumbling_count")
def q_events_tumbling_count(spark, sf_dir):
    root = scratch_path(spark, "counts")
    ev = jobs.read_stream(spark, _events_path(sf_dir))
    q = jobs.emit_counts(jobs.windowed_counts(ev), f"{root}/log", f"{root}/_checkpoint", AVAILABLE_NOW)
    q.awaitTermination()
    return jobs.current_counts(spark.read.parquet(f"{root}/log"))


@register("events_counts_late")
def q_events_counts_late(spark, sf_dir):
    """Counts per window over three deliveries, each a trigger of its own, in
    which a window's events come late, and every 40th has no time at all."""
    root = scratch_path(spark, "counts-late")
    ev = td.read(spark, sf_dir, "events")
    ev = ev.withColumn("ts", F.when(F.col("event_id") % 40 != 0, F.col("ts")))
    for part in (2, 1, 0):
        ev.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")
        jobs.emit_counts(jobs.windowed_counts(jobs.read_stream(spark, f"{root}/in")), f"{root}/log",
                         f"{root}/_checkpoint", AVAILABLE_NOW).awaitTermination()
    return jobs.current_counts(spark.read.parquet(f"{root}/log"))


@register("stream_progress")
def q_stream_progress(spark, sf_dir):
    """Progress of a stream's batches, as its listener logged it: rows taken
    by each of three deliveries."""
    root = scratch_path(spark, "progress")
    name = f"land-{root[-12:]}"
    ev = td.read(spark, sf_dir, "events")
    with ProgressLog(spark, f"{root}/progress") as log:
        for part in range(3):
            ev.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
            src = jobs.read_stream(spark, f"{root}/in")
            q = jobs.land_changes(src, f"{root}/raw", f"{root}/_checkpoint", AVAILABLE_NOW, name)
            q.awaitTermination()
    return log.read().where((F.col("query_name") == name) & (F.col("input_rows") > 0)) \
        .select("batch_id", "input_rows")


@register("pipeline_lag")
def q_pipeline_lag(spark, sf_dir):
    committed = spark.createDataFrame(list(td.CONSUMER_POSITIONS), "consumer_name string, committed_ts string") \
        .withColumn("committed_ts", F.col("committed_ts").cast("timestamp_ntz"))
    return jobs.pipeline_lag(td.read(spark, sf_dir, "events"), committed)


@register("dq_failures")
def q_dq_failures(spark, sf_dir):
    """The test suite run with stored failures: one row per failing row of
    a row-level check, one per offending key of a unique/relationship
    check, appended to the failures table of this run."""
    from ..operators import quality as q
    from .catalog import build_fct_orders, fct_checks, raw_orders_checks

    path = scratch_path(spark, "dq_failures")
    specs = [raw_orders_checks(td.raw_orders(spark, sf_dir)), fct_checks(build_fct_orders(spark, sf_dir))]
    q.store_failures(q.suite_failures(specs), path, "run-1")
    return spark.read.parquet(path).where(F.col("run_id") == "run-1").drop("run_id")
