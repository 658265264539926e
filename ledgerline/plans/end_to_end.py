"""The layers end to end, timed per stage, for comparison with the stated
latency targets (change stream -> raw, raw -> staging, staging -> marts,
batch ingest -> marts).

Stages:
  cdc_to_raw            change files landed in the raw layer by the stream
  batch_ingest_to_raw   five source tables extracted and appended (concurrent)
  raw_to_staging        staging models materialised from raw
  staging_to_marts      fact built, tested and published (write-audit-publish)
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from ..operators import quality
from ..sources import testdata as td
from ..sources.extract import SourceSpec
from ..sources.loader import IncrementalLoader
from ..streaming import jobs
from . import marts, staging

# Latency targets (seconds) the stages are compared with.
TARGETS_SEC = {"cdc_to_raw": 120, "raw_to_staging": 600, "staging_to_marts": 1800,
               "batch_ingest_to_marts": 14400}

SOURCES = {
    "orders": ("order_id", td.source_orders),
    "customers": ("customer_id", td.source_customers),
    "products": ("product_id", td.source_products),
    "order_items": ("order_id", td.source_order_items),
    "payments": ("payment_id", td.source_payments),
}


def run_layers(spark: SparkSession, sf_dir: str, root: str) -> dict[str, float]:
    t: dict[str, float] = {}

    t0 = time.perf_counter()
    q = jobs.land_changes(jobs.read_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet"),
                          f"{root}/raw/events", f"{root}/_checkpoints/land_events", {"availableNow": True})
    q.awaitTermination()
    t["cdc_to_raw"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    loader = IncrementalLoader(spark, root)

    def job(name, key, build):
        spec = SourceSpec(name, "updated_at" if name != "order_items" else "created_at", (key,))
        return lambda ld: ld.load(spec, build(spark, sf_dir))

    loader.run_tables([job(n, k, b) for n, (k, b) in SOURCES.items()], parallelism=5)
    t["batch_ingest_to_raw"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    raw_o = loader.read_raw("orders")
    raw_c = loader.read_raw("customers")
    stg_o, stg_c = staging.stg_orders(raw_o), staging.stg_customers(raw_c, strict_uuid=False)
    stg_o.write.mode("overwrite").parquet(f"{root}/staging/stg_orders")
    stg_c.write.mode("overwrite").parquet(f"{root}/staging/stg_customers")
    t["raw_to_staging"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    fct = marts.fct_orders(spark.read.parquet(f"{root}/staging/stg_orders"),
                           spark.read.parquet(f"{root}/staging/stg_customers"))

    def checks(df):
        return [quality.TableChecks(
            "fct_orders", df,
            row_checks=[quality.expression_is_true("order_total_usd_ge_0", "order_total_usd >= 0"),
                        quality.not_null("order_id"), quality.not_null("customer_id"),
                        quality.not_null("order_total_usd"), quality.not_null("created_at")],
            unique=[["order_id"]])]

    quality.publish(fct, f"{root}/marts/fct_orders", checks, run_id="bench")
    t["staging_to_marts"] = time.perf_counter() - t0
    t["batch_ingest_to_marts"] = t["batch_ingest_to_raw"] + t["raw_to_staging"] + t["staging_to_marts"]
    return {k: round(v, 3) for k, v in t.items()}
