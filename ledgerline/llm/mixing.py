"""Mixing sources to target weights, in DataFrame operations only.

Tokens are counted per source, targets follow from the sources' weights, and
a document is emitted floor(rate) times plus one more time when its seeded
hash falls below the fraction, rate = target / source size.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; a source without tokens has target 0 and rate 0; an empty table
gives an empty result; repeated rows draw alike (same id, source and text);
further columns of the input are left alone and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut, prefix_sums

SEED = 20240607
MAX_REPEAT = 3.0
BROADCAST_BYTES = 8 << 20    # of the sources' table, at most


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3),
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``sizes``: (source, source_size). Adds ``target``.

    Weights repeat over the sources in code point order. Targets share the
    total by weight; one above ``max_repeat`` times its source's size stops
    there and the excess is shared again. With m the common factor this is
    target = min(cap, m * weight); m is found by aggregates over the sources
    table, one row to the driver a round, until no further source is capped.
    """
    k = len(weights)
    ranked = prefix_sums(sizes.withColumn("_one", F.lit(1).cast("long")),
                         [F.col("source").asc_nulls_last()], {"_rank": "_one"}, "mix-sources")
    table = cut(ranked.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                     (F.col("_rank") % k + 1).cast("int")).alias("_w"),
        (F.col("source_size") * F.lit(float(max_repeat))).alias("_cap")), "mix-weights")
    factor, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.lit(factor) * F.col("_w")
        r = table.agg(F.sum("source_size").alias("total"), F.count(F.when(full, 1)).alias("n"),
                      F.sum(F.when(full, F.col("_cap"))).alias("at_cap"),
                      F.sum(F.when(~full, F.col("_w"))).alias("w")).first()
        if r["total"] and r["w"] is None:       # every source stops at its cap
            factor = float("inf")
        if not r["total"] or r["w"] is None or r["n"] == capped:
            break
        capped, factor = r["n"], max(factor, (r["total"] - (r["at_cap"] or 0.0)) / r["w"])
    return table.select("source", "source_size", F.least(
        F.col("_cap"), F.lit(float(factor)) * F.col("_w")).alias("target"))


def mix_plan(docs: DataFrame, text_col: str = "text", source_col: str = "source",
             id_col: str = "doc_id", weights: Sequence[float] = (1, 2, 3),
             max_repeat: float = MAX_REPEAT, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """(id, size, source_size, target, copies, carry...) per row of ``docs``.

    A hot source is pre-aggregated before its shuffle. The sources' table is
    broadcast if its measured bytes are within BROADCAST_BYTES, so that no row
    of ``docs`` is shuffled; beyond that the same join is a sort-merge join
    whose hot partitions AQE splits.
    """
    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        # 53 bits of the hash as a number in [0, 1)
        (F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))).alias("_u"),
        *[F.col(c).alias(f"_c_{c}") for c in carry])
    if not carry:
        rows = cut(rows, "mix-rows")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                             weights, max_repeat)
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    size = t.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("_s"), F.lit(0)) + 64), F.lit(0))).first()[0]
    t = F.broadcast(t) if size <= BROADCAST_BYTES else t.hint("merge")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    return (rows.join(t, F.col("source").eqNullSafe(F.col("_s")))
            .select(F.col("_id").alias(id_col), "size", "source_size", "target",
                    (whole + (F.col("_u") < rate - whole).cast("long")).alias("copies"),
                    *[f"_c_{c}" for c in carry]))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: each row of ``docs`` repeated ``copies`` times."""
    cols = docs.columns
    plan = mix_plan(docs, carry=cols, **kw)
    return (plan.where(F.col("copies") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*[F.col(f"_c_{c}").alias(c) for c in cols]))
