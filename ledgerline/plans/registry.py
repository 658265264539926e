"""Model registry: named DataFrame functions with dependencies, tags and
a materialisation.

A model is ``fn(inputs: dict[str, DataFrame]) -> DataFrame``, or a SELECT
(``sql``) that names its inputs as ``{stg_orders}`` or ``{raw.orders}``; inputs
are sources (``source:raw.orders``) or other models. ``build`` resolves the
selected models and their upstream closure in dependency order and
materialises each:

* ``view``      - a temp view over the lazy plan (Catalyst inlines it into
                  every consumer, so filters reach the raw scan); in an
                  environment, a SELECT model is a permanent view of its layer;
* ``ephemeral`` - not registered at all, only inlined into consumers;
* ``table``     - written as a parquet table, clustered by ``cluster_by``
                  (see ``operators/versions.py``). In an environment it is a
                  table of its layer's database, published by location swap;
                  with ``table_path`` it is a folder, put in place by renaming.
                  ``partition_by`` adds directory partitions (folders only).

Checks run on what was written, before it is published. Column docs are kept
in the files and, with the model's description, in the catalog. With an
environment, every job carries the target's tag and the model's name, and the
target's number of threads builds the models of a level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..config import Environment
from ..operators.versions import clustered, with_docs

ModelFn = Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class Model:
    name: str
    fn: ModelFn
    deps: tuple[str, ...] = ()
    materialized: str = "view"  # view | table | ephemeral
    tags: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    description: str = ""
    column_docs: dict[str, str] = field(default_factory=dict)
    # df -> list[quality.TableChecks]; a table model with checks is built
    # write-audit-publish: candidate written, checked, then swapped in
    checks: Callable | None = None
    sql: str | None = None      # a SELECT over {inputs}, instead of fn
    layer: str | None = None    # default: the first of its tags that is a layer, else marts


@dataclass
class Registry:
    models: dict[str, Model] = field(default_factory=dict)
    sources: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)

    def source(self, name: str, loader: Callable[[], DataFrame]) -> None:
        self.sources[f"source:{name}"] = loader

    def model(self, name: str, deps: Iterable[str] = (), materialized: str = "view",
              tags: Iterable[str] = (), cluster_by: Iterable[str] = (),
              partition_by: Iterable[str] = (), description: str = "",
              column_docs: dict[str, str] | None = None, checks: Callable | None = None,
              layer: str | None = None):
        def deco(fn: ModelFn) -> ModelFn:
            self.models[name] = Model(name, fn, tuple(deps), materialized, tuple(tags),
                                      tuple(cluster_by), tuple(partition_by), description,
                                      dict(column_docs or {}), checks, None, layer)
            return fn
        return deco

    def sql_model(self, name: str, select: str, deps: Iterable[str] = (), materialized: str = "view", **kw) -> None:
        """A model stated as a SELECT; ``{dep}`` stands for an input's name."""
        deps = tuple(deps)

        def fn(inputs: dict[str, DataFrame]) -> DataFrame:
            spark = next(iter(inputs.values())).sparkSession
            return spark.sql(_filled(select, {d: "{" + _arg(d) + "}" for d in deps}),
                             **{_arg(d): inputs[d] for d in deps})
        self.model(name, deps, materialized, **kw)(fn)
        self.models[name].sql = select

    # -- selection ---------------------------------------------------------
    def select(self, names: Iterable[str] = (), tags: Iterable[str] = ()) -> list[str]:
        """Selected models plus everything upstream, in dependency order."""
        names, tags = set(names), set(tags)
        chosen = [m.name for m in self.models.values()
                  if m.name in names or (tags and tags & set(m.tags))]
        if not names and not tags:
            chosen = list(self.models)
        order: list[str] = []
        seen: set[str] = set()

        def visit(n: str, stack: tuple[str, ...] = ()) -> None:
            if n in seen or n.startswith("source:"):
                return
            if n in stack:
                raise ValueError(f"dependency cycle through {n}")
            for d in self.models[n].deps:
                visit(d, stack + (n,))
            seen.add(n)
            order.append(n)

        for n in chosen:
            visit(n)
        return order

    # -- build -------------------------------------------------------------
    def levels(self, order: list[str]) -> list[list[str]]:
        """Group models so that each one comes after all its dependencies;
        models of one level are independent of each other."""
        depth: dict[str, int] = {}
        for n in order:
            ds = [depth[d] for d in self.models[n].deps if d in depth]
            depth[n] = 1 + max(ds) if ds else 0
        out: list[list[str]] = [[] for _ in range(max(depth.values(), default=-1) + 1)]
        for n in order:
            out[depth[n]].append(n)
        return out

    def build(self, spark: SparkSession, names: Iterable[str] = (), tags: Iterable[str] = (),
              table_path: Callable[[str], str] | None = None, threads: int | None = None,
              env: Environment | None = None) -> dict[str, DataFrame]:
        """Materialise the selection. Models of one dependency level are
        built concurrently (``threads``; by default the target's); Spark runs
        their jobs side by side."""
        from concurrent.futures import ThreadPoolExecutor

        threads = threads or (env.target.threads if env else 1)
        built: dict[str, DataFrame] = {}
        if env is not None:
            env.ensure_databases()

        def get(n: str) -> DataFrame:
            if n not in built and n.startswith("source:"):
                built[n] = self.sources[n]()
            return built[n]

        def make(n: str) -> tuple[str, DataFrame]:
            m = self.models[n]
            if env is None:
                return n, self._made(spark, m, {d: get(d) for d in m.deps}, table_path)
            with env.tagged(f"build {n}"):
                return n, self._made_in(env, m, {d: get(d) for d in m.deps})

        for level in self.levels(self.select(names, tags)):
            for m in level:
                for d in self.models[m].deps:
                    if d.startswith("source:"):
                        get(d)
            if threads > 1 and len(level) > 1:
                with ThreadPoolExecutor(max_workers=threads) as pool:
                    results = list(pool.map(make, level))
            else:
                results = [make(n) for n in level]
            built.update(results)
        return built

    @staticmethod
    def _made(spark: SparkSession, m: Model, inputs: dict[str, DataFrame],
              table_path: Callable[[str], str] | None) -> DataFrame:
        df = with_docs(m.fn(inputs), m.column_docs)
        if m.materialized == "view":
            df.createOrReplaceTempView(m.name)
        if m.materialized != "table":
            return df
        if table_path is None:
            raise ValueError("table materialisation needs table_path or an environment")
        path, out = table_path(m.name), clustered(df, m.cluster_by)
        if m.checks is not None:
            from ..operators.quality import publish
            # raises QualityGateError and leaves the published table as it was
            publish(out, path, m.checks, m.partition_by, run_id=m.name)
        else:
            w = out.write.mode("overwrite")
            if m.partition_by:
                w = w.partitionBy(*m.partition_by).option("partitionOverwriteMode", "static")
            w.parquet(path)
        return spark.read.parquet(path)

    def _layer(self, env: Environment, m: Model) -> str:
        return m.layer or next((t for t in m.tags if t in env.target.databases), "marts")

    def _made_in(self, env: Environment, m: Model, inputs: dict[str, DataFrame]) -> DataFrame:
        layer = self._layer(env, m)
        if m.materialized == "table":
            if m.partition_by:
                raise ValueError(f"{m.name}: a catalog table is clustered, not partitioned")
            table = env.versioned(layer, m.name, m.description)
            table.publish(m.fn(inputs), m.checks, m.cluster_by, m.column_docs)
            return env.spark.table(table.table)
        # a permanent view can only name permanent inputs
        names = {d: self._name(env, d) for d in m.deps}
        if m.materialized == "view" and m.sql is not None and all(names.values()):
            return env.spark.table(env.view(layer, m.name, _filled(m.sql, names), m.description))
        df = with_docs(m.fn(inputs), m.column_docs)
        if m.materialized == "view":
            df.createOrReplaceTempView(m.name)
        return df

    def _name(self, env: Environment, dep: str) -> str | None:
        """Catalog name of an input, if it has one."""
        if dep.startswith("source:"):
            layer, _, name = _short(dep).partition(".")
            name = env.target.table(layer, name) if layer in env.target.databases else None
        else:
            m = self.models[dep]
            name = None if m.materialized == "ephemeral" else env.target.table(self._layer(env, m), dep)
        return name if name and env.spark.catalog.tableExists(name) else None


def _filled(select: str, names: dict[str, str]) -> str:
    for dep, name in names.items():
        select = select.replace("{" + _short(dep) + "}", name)
    return select


def _short(dep: str) -> str:
    return dep.removeprefix("source:")


def _arg(dep: str) -> str:
    return _short(dep).replace(".", "_")


def finance_registry(raw_orders: Callable[[], DataFrame],
                     raw_customers: Callable[[], DataFrame]) -> Registry:
    """The finance models: two staging views and the order fact, with
    their tags."""
    from ..operators import quality
    from . import marts, staging

    def _fct_checks(df):
        return [quality.TableChecks(
            "fct_orders", df,
            row_checks=[quality.expression_is_true("expression_order_total_usd_ge_0", "order_total_usd >= 0"),
                        quality.not_null("order_id"), quality.not_null("customer_id"),
                        quality.not_null("order_total_usd"), quality.not_null("created_at")],
            unique=[["order_id"]])]

    reg = Registry()
    reg.source("raw.orders", raw_orders)
    reg.source("raw.customers", raw_customers)

    @reg.model("stg_orders", deps=["source:raw.orders"], tags=["staging", "orders"])
    def _stg_orders(i):
        return staging.stg_orders(i["source:raw.orders"])

    @reg.model("stg_customers", deps=["source:raw.customers"], tags=["staging", "customers"])
    def _stg_customers(i):
        return staging.stg_customers(i["source:raw.customers"])

    @reg.model("fct_orders", deps=["stg_orders", "stg_customers"], materialized="table",
               tags=["marts", "finance", "critical"], cluster_by=["to_date(created_at)"],
               description="One row per order with customer context",
               column_docs={"order_id": "order key", "net_revenue_usd": "total minus tax"},
               checks=_fct_checks)
    def _fct(i):
        return marts.fct_orders(i["stg_orders"], i["stg_customers"])

    return reg
