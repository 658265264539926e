from conftest import SF_SMALL
from ledgerline.config import Environment, default_targets
from ledgerline.plans.registry import finance_registry
from ledgerline.sources import testdata as td


def _reg(spark):
    return finance_registry(lambda: td.raw_orders(spark, SF_SMALL), lambda: td.raw_customers(spark, SF_SMALL))


def test_select_by_tag_includes_upstream(spark):
    reg = _reg(spark)
    assert reg.select(tags=["finance"]) == ["stg_orders", "stg_customers", "fct_orders"]
    assert reg.select(names=["stg_customers"]) == ["stg_customers"]
    assert reg.select(tags=["staging"]) == ["stg_orders", "stg_customers"]


def test_build_materialises_views_and_tables(spark, scratch):
    reg = _reg(spark)
    root = scratch("models")
    out = reg.build(spark, names=["fct_orders"], table_path=lambda n: f"{root}/{n}")
    assert spark.table("stg_orders").count() == out["stg_orders"].count()
    fct = spark.read.parquet(f"{root}/fct_orders")
    assert fct.count() == out["stg_orders"].count()
    assert fct.schema["net_revenue_usd"].metadata.get("comment") == "total minus tax"
    # clustered by day: each file holds a contiguous range of created_at
    plan = fct.where("created_at < '1996-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan


def test_environment_routes_layers(spark):
    t = default_targets("lakehouse")["dev"]
    assert t.table("raw", "orders") == "lakehouse_dev_raw.orders"
    env = Environment(spark, t)
    with env.tagged("build fct_orders"):
        assert t.query_tag in spark.sparkContext.getJobTags()
    assert t.query_tag not in spark.sparkContext.getJobTags()


def test_layers_end_to_end(spark, scratch):
    from ledgerline.plans.end_to_end import TARGETS_SEC, run_layers
    root = scratch("layers")
    t = run_layers(spark, SF_SMALL, root)
    assert set(TARGETS_SEC) <= set(t)
    fct = spark.read.parquet(f"{root}/marts/fct_orders")
    assert fct.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


def test_databases_created_per_layer_and_ephemeral_models(spark, scratch):
    from ledgerline.config import Target
    from ledgerline.plans.registry import Registry
    loc = scratch("warehouse")
    t = Target("ci", {"raw": "ll_ci_raw", "marts": "ll_ci_marts"}, location=loc)
    env = Environment(spark, t)
    env.ensure_databases()
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"ll_ci_raw", "ll_ci_marts"} <= names

    reg = Registry()
    reg.source("raw.orders", lambda: td.raw_orders(spark, SF_SMALL))

    @reg.model("ids", deps=["source:raw.orders"], materialized="ephemeral")
    def _ids(i):
        return i["source:raw.orders"].select("order_id")

    @reg.model("n", deps=["ids"], materialized="view")
    def _n(i):
        return i["ids"].groupBy().count()

    out = reg.build(spark, names=["n"])
    assert not spark.catalog.tableExists("ids")
    assert out["n"].first()[0] == td.raw_orders(spark, SF_SMALL).count()


def test_levels_and_parallel_build(spark, scratch):
    reg = _reg(spark)
    assert reg.levels(reg.select()) == [["stg_orders", "stg_customers"], ["fct_orders"]]
    root = scratch("models")
    out = reg.build(spark, tags=["finance"], table_path=lambda n: f"{root}/{n}", threads=4)
    assert out["fct_orders"].count() == out["stg_orders"].count()


def test_cluster_conf_scales_with_input():
    from ledgerline.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 200_000
    small = cluster_conf(10 * 1024 ** 3, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80


def test_failing_model_tests_block_the_publish(spark, scratch):
    import pytest
    from ledgerline.operators.quality import QualityGateError
    root = scratch("models")
    good = _reg(spark)
    good.build(spark, names=["fct_orders"], table_path=lambda n: f"{root}/{n}")
    before = spark.read.parquet(f"{root}/fct_orders").count()
    # a broken upstream: every order duplicated
    bad = finance_registry(lambda: td.raw_orders(spark, SF_SMALL), lambda: td.raw_customers(spark, SF_SMALL))
    fn = bad.models["stg_orders"].fn
    bad.models["stg_orders"].fn = lambda i: fn(i).unionByName(fn(i))
    with pytest.raises(QualityGateError):
        bad.build(spark, names=["fct_orders"], table_path=lambda n: f"{root}/{n}")
    assert spark.read.parquet(f"{root}/fct_orders").count() == before


def _target(name, loc):
    from ledgerline.config import Target
    return Target("ci", {x: f"ll_{name}_{x}" for x in ("raw", "staging", "marts")}, threads=3, query_tag=f"tag-{name}",
                  location=loc)


def test_catalog_build_with_layers_views_docs_and_tag(spark, scratch):
    env = Environment(spark, _target("cat", scratch("warehouse")))
    path = scratch("raw")
    td.raw_orders(spark, SF_SMALL).write.parquet(path)
    env.view_over("raw", "orders", path, "all loads")
    reg = _reg(spark)
    reg.sources["source:raw.orders"] = lambda: spark.table(env.target.table("raw", "orders"))
    reg.sql_model("order_days", "SELECT to_date(created_at) AS day, count(*) AS n FROM {fct_orders} GROUP BY 1",
                  deps=["fct_orders"], tags=["marts"], description="it's by day")
    reg.sql_model("open_orders", "SELECT * FROM {raw.orders} WHERE status = 'processing'",
                  deps=["source:raw.orders"], tags=["staging"])
    out = reg.build(spark, env=env)
    fct = spark.table("ll_cat_marts.fct_orders")
    assert fct.count() == out["stg_orders"].count()
    assert fct.schema["net_revenue_usd"].metadata.get("comment") == "total minus tax"
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED ll_cat_marts.fct_orders").collect()}
    assert info["Comment"] == "One row per order with customer context"
    # permanent views, usable from any session of the catalog
    assert spark.newSession().table("ll_cat_marts.order_days").groupBy().sum("n").first()[0] == fct.count()
    assert spark.table("ll_cat_staging.open_orders").count() == out["open_orders"].count() > 0
    jobs = spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag("tag-cat")
    assert len(list(jobs)) > 0


def test_rebuild_is_seen_whole_by_readers(spark, scratch):
    """Readers during rebuilds see one version's rows: all 100 or all 200."""
    import threading
    env = Environment(spark, _target("swap", scratch("warehouse")))
    t = env.versioned("marts", "numbers", "numbers")
    t.publish(spark.range(100))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table(t.table).agg({"id": "count"}).first()[0])
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (200, 100, 200, 100, 200):
            t.publish(spark.range(n))
    finally:
        stop.set()
        reader.join()
    assert seen and set(seen) <= {100, 200}
    now = t.location()
    assert len(t.retire(keep=1)) == 4 and t.retire(keep=1) == []
    assert t.location() == now and spark.table(t.table).count() == 200
    # other columns: a new definition
    t.publish(spark.range(5).withColumnRenamed("id", "n"))
    assert spark.table(t.table).columns == ["n"]


def test_failing_gate_keeps_the_published_version(spark, scratch):
    import pytest
    from ledgerline.operators import quality
    env = Environment(spark, _target("gate", scratch("warehouse")))
    t = env.versioned("marts", "numbers")

    def checks(df):
        return [quality.TableChecks("numbers", df, row_checks=[quality.not_null("id")], unique=[["id"]])]
    assert {r.status for r in t.publish(spark.range(10), checks).collect()} == {"pass"}
    with pytest.raises(quality.QualityGateError):
        t.publish(spark.range(10).unionByName(spark.range(1)), checks)
    assert spark.table(t.table).count() == 10


def test_clustering_survives_publishing_and_cuts_a_hot_day(spark, scratch):
    from pyspark.sql import functions as F
    i = F.col("id")
    df = spark.range(20_000).select(i, F.expr("date'2024-01-01'").alias("d0")) \
        .select("id", F.date_add("d0", F.when(i % 3 == 0, 15).otherwise(i % 31).cast("int")).alias("day"))
    env = Environment(spark, _target("clu", scratch("warehouse")))
    t = env.versioned("marts", "days")

    def files(table):
        return table.groupBy(F.col("_metadata.file_name").alias("f")).agg(
            F.min("day").alias("lo"), F.max("day").alias("hi"), F.count("*").alias("n")).orderBy("lo", "hi").collect()

    def checks(d):
        from ledgerline.operators import quality
        return [quality.TableChecks("days", d, row_checks=[quality.not_null("day")])]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.publish(df, checks, ["day"])
        path = scratch("folder")
        from ledgerline.operators import quality
        from ledgerline.operators.versions import clustered
        quality.publish(clustered(df, ["day"]), path, checks)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    for table in (spark.table(t.table), spark.read.parquet(path)):
        f = files(table)
        assert len(f) > 4 and sum(x.n for x in f) == 20_000
        # files follow one another: neighbours share at most the day at their edge
        assert all(a.hi <= b.lo for a, b in zip(f, f[1:]))
        # the day with over a third of all rows lies in several files
        hot = [x for x in f if str(x.lo) <= "2024-01-16" <= str(x.hi)]
        assert len(hot) > 1 and max(x.n for x in f) < 20_000 / 4
    assert len(files(spark.table(t.table).where("day = date'2024-01-03'"))) <= 2
    t.publish(df, None, ["day"], rows_per_file=500)
    assert max(x.n for x in files(spark.table(t.table))) <= 500
