"""Sharding by a hierarchical weighted hash tree, in DataFrame operations only.

A row descends the tree root -> region -> rack -> shard. At every node each
child draws -ln(u) / weight, u a hash of (seed, id, child) in (0, 1), and the
smallest draw wins, so a child wins in proportion to its weight, which is the
sum of the weights below it. A draw depends on its child alone: when a weight
changes, only rows that the changed child wins or loses move, at each level, so
that movement stays inside the subtrees whose weights change. A shard that
opens a region of its own (``layout`` puts every eighth shard there) takes rows
into itself only; a shard added to an old region also draws rows into that
region's other shards.

The law is ``key``: the id and the tree decide, nothing else. Rows with equal
texts but different ids are therefore placed apart; ``text_crc32`` tells them.

Slots number a shard's rows from 0 without gaps, in the order of id and text
hash. They come from one range sort of narrow rows over all shards and prefix
sums over its ranges, so that no task holds a shard.

Defined cases: a null id is an id like another (all such rows share a shard,
and are still sorted in many tasks, since a row number is the last sort key);
null texts have size 1 and the checksum of the empty text; texts of any length
are only measured and summed; repeated rows share a shard and have slots of
their own; an empty table gives no rows; other columns are unused.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, prefix_sums

SEED = 20240613
SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, per_rack: int = SHARDS_PER_RACK,
           racks: int = RACKS_PER_REGION) -> list[Shard]:
    """``shards`` equal shards, racks and regions filled one after the other."""
    return [Shard(i // (per_rack * racks), i // per_rack, i) for i in range(shards)]


def _children(tree: Sequence[Shard], level: int) -> dict[int, dict[int, float]]:
    """Weights of the children of each node of ``level`` (0: the root)."""
    out: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    for s in tree:
        if s.weight < 0:
            raise ValueError(f"shard {s.shard} has a negative weight")
        if s.weight > 0:
            out[(0, s.region, s.rack)[level]][s[level]] += float(s.weight)
    return out


def _check(tree: Sequence[Shard]) -> None:
    for kind, parent in ((1, 0), (2, 1)):
        above: dict[int, int] = {}
        for s in tree:
            if above.setdefault(s[kind], s[parent]) != s[parent]:
                raise ValueError(f"{('region', 'rack', 'shard')[kind]} {s[kind]} has two parents")
    if len({s.shard for s in tree}) != len(tree) or not any(s.weight > 0 for s in tree):
        raise ValueError("shards must be distinct and have weight")


def draw(id_: Column, level: int, child: Column, weight: Column, seed: int = SEED) -> Column:
    h = F.xxhash64(F.lit(seed).cast("long"), F.lit(level).cast("long"), child, id_.cast("long"))
    u = (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / weight


def _drawn(id_: Column, level: int, seed: int):
    return lambda c: F.struct(draw(id_, level, c["id"], c["w"], seed).alias("d"), c["id"].alias("id"))


def descend(id_: Column, tree: Sequence[Shard], seed: int = SEED) -> list[Column]:
    """(region, rack, shard) columns of an id. Only the children of the nodes
    on a row's path draw; ties of a draw go to the smaller child."""
    _check(tree)
    node, path = F.lit(0).cast("long"), []
    for level in range(3):
        table = F.create_map(*[x for parent, kids in sorted(_children(tree, level).items())
                               for x in (F.lit(parent).cast("long"), F.array(*[
                                   F.struct(F.lit(k).cast("long").alias("id"), F.lit(w).alias("w"))
                                   for k, w in sorted(kids.items())]))])
        node = F.array_min(F.transform(F.element_at(table, node), _drawn(id_, level, seed)))["id"]
        path.append(node)
    return path


def place(docs: DataFrame, tree: Sequence[Shard], grown: Sequence[Shard], id_col: str = "doc_id",
          text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack)
    per row: its place in ``tree`` and its shard in ``grown``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    id_ = F.col("doc_id")
    region, rack, shard = descend(id_, tree, seed)
    rows = cut(rows.select("*", region.alias("region"), rack.alias("rack"), shard.alias("shard"),
                           descend(id_, grown, seed)[2].alias("grown_shard")), "shard-rows")
    order = [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("_text"), F.col("_row")]
    at = prefix_sums(rows.withColumn("_one", F.lit(1).cast("long")), order, {"_at": "_one"}, "shard-order")
    # one row a shard: bounded by the tree
    first = rows.groupBy("shard").count().select("shard", F.col("count").alias("_n")).collect()
    base, bases = 0, {}
    for r in sorted(first, key=lambda r: r["shard"]):
        bases[r["shard"]], base = base, base + r["_n"]
    start = F.lit(0).cast("long")
    if bases:
        start = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in bases.items() for x in kv]),
                             F.col("shard"))
    return at.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                     F.col("shard").cast("int").alias("shard"), (F.col("_at") - start).alias("slot"),
                     F.col("grown_shard").cast("int").alias("grown_shard"),
                     F.col("region").cast("int").alias("region"), F.col("rack").cast("int").alias("rack"))
