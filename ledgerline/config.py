"""Environment targets and the layer -> database routing.

One object answers "where does layer X live in environment Y": raw,
staging, intermediate and marts each map to a database (a catalog schema
or a path prefix). Sources and models resolve their tables through it,
so the loader and the models cannot disagree on the raw schema.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .operators.versions import VersionedTable, quoted

LAYERS = ("raw", "staging", "intermediate", "marts", "audit")


@dataclass(frozen=True)
class Target:
    name: str                      # dev / prod / ...
    databases: dict[str, str]      # layer -> database
    threads: int = 4               # models built concurrently
    query_tag: str | None = None   # attached to every Spark job
    location: str | None = None    # optional root path of managed tables

    def database(self, layer: str) -> str:
        return self.databases[layer]

    def table(self, layer: str, name: str) -> str:
        return f"{self.databases[layer]}.{name}"


def default_targets(prefix: str = "analytics") -> dict[str, Target]:
    def dbs(env: str) -> dict[str, str]:
        return {layer: f"{prefix}_{env}_{layer}" for layer in LAYERS}
    return {
        "dev": Target("dev", dbs("dev"), threads=4, query_tag="dev"),
        "prod": Target("prod", dbs("prod"), threads=8, query_tag="prod"),
    }


@dataclass
class Environment:
    """A target in a session: its databases, tables, views and job tags."""

    spark: SparkSession
    target: Target
    created: set[str] = field(default_factory=set)

    def ensure_databases(self) -> None:
        """CREATE DATABASE IF NOT EXISTS for every layer."""
        for layer, db in self.target.databases.items():
            if db in self.created:
                continue
            loc = f" LOCATION '{self.folder(layer)}'" if self.target.location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
            self.created.add(db)

    def folder(self, layer: str) -> str:
        if not self.target.location:
            raise ValueError(f"target {self.target.name} has no location")
        return f"{self.target.location}/{self.target.database(layer)}.db"

    def versioned(self, layer: str, name: str, description: str = "") -> VersionedTable:
        """The layer's table ``name``, published by location swap."""
        self.ensure_databases()
        return VersionedTable(self.spark, self.target.table(layer, name), f"{self.folder(layer)}/{name}", description)

    def view_over(self, layer: str, name: str, path: str, description: str = "") -> str:
        """A permanent view of all files under ``path`` (an appended raw table
        shows new loads at once); returns its name."""
        return self.view(layer, name, f"SELECT * FROM parquet.`{path}`", description)

    def view(self, layer: str, name: str, select: str, description: str = "") -> str:
        self.ensure_databases()
        table = self.target.table(layer, name)
        note = f" COMMENT {quoted(description)}" if description else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {table}{note} AS {select}")
        return table

    @contextmanager
    def tagged(self, description: str) -> Iterator[None]:
        """Jobs started inside (in this thread) carry the target's tag and the
        description."""
        sc, tag = self.spark.sparkContext, self.target.query_tag
        if tag:
            sc.addJobTag(tag)
        sc.setJobDescription(description)
        try:
            yield
        finally:
            sc.setJobDescription(None)
            if tag:
                sc.removeJobTag(tag)
