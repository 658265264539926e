"""Helpers the operators share: written intermediates, distributed prefix
sums, and vectorised word hashing inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Word rule of every operator here: runs of bytes other than space and
# U+0009..U+000D. All delimiters are ASCII, so UTF-8 bytes can be scanned.
WORD = r"[^\x20\x09-\x0D]+"

PIECE_BYTES = 1 << 20        # text handled at once inside a task
ARROW_ROWS = 256             # rows per Arrow batch: bounds a worker's memory on long texts
_M = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, for the plans that ship whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table under the cluster's shared checkpoint
    folder and read it back: lineage ends there, values are fixed, and a lost
    executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_sums(df: DataFrame, order: Sequence[Column | str], sums: dict[str, str],
                name: str) -> DataFrame:
    """Exclusive running sums over the whole table in ``order``.

    ``sums`` maps an output column to the summed column. The rows (keep them
    narrow) are range-sorted once and written with their partition number;
    running sums are taken inside each range, and the ranges' totals, one row
    per partition, are carried over. No task holds more than its range.
    Ties in ``order`` are broken by the written row order.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_row", F.monotonically_increasing_id()), name)
    inside = Window.partitionBy("_pid").orderBy("_row").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = at.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    across = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{o}").over(across), F.lit(0))
                                    .alias(f"_b_{o}") for o in sums])
    # one row per range partition: bounded by the partition count
    out = at.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_i_{o}")
                           for o, c in sums.items()]).join(F.broadcast(bases), "_pid")
    return out.select(*df.columns, *[(F.col(f"_i_{o}") + F.col(f"_b_{o}")).alias(o)
                                     for o in sums])


def hot_join(rows: DataFrame, groups: DataFrame, on: Sequence[str], count: str, spread: Column,
             hot: int = 10_000, most: int = 200_000) -> DataFrame:
    """``rows`` LEFT JOIN ``groups``, which hold one row per key with the
    key's number of rows in ``count``. The groups of ``hot`` rows or more (at
    most rows / hot of them) are broadcast if there are at most ``most``; their
    rows are then kept apart by ``spread`` in the other groups' join, so that no
    task gets a hot group. Groups so many that they cannot be broadcast are no
    large part of the rows each. Keys are not null."""
    carried = [c for c in groups.columns if c not in on]
    few = groups.where(F.col(count) >= hot)
    some = few.limit(most + 1).count()
    if not 0 < some <= most:
        return rows.join(groups.hint("merge"), list(on), "left")
    few = few.select(*on, *[F.col(c).alias(f"_hot_{c}") for c in carried])
    apart = F.when(F.col(f"_hot_{count}").isNotNull(), spread).otherwise(F.lit(0)).cast("long")
    known = rows.join(F.broadcast(few), list(on), "left").withColumn("_spread", apart)
    cold = groups.where(F.col(count) < hot).withColumn("_spread", F.lit(0).cast("long"))
    out = known.join(cold.hint("merge"), [*on, "_spread"], "left")
    return out.select(*rows.columns, *[F.coalesce(f"_hot_{c}", c).alias(c) for c in carried])


# -- hashing inside tasks ------------------------------------------------------
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _BASE, np.uint64)
    p[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(p)


_POW = powers(4096)


def _split_long(raw: bytes) -> list[bytes]:
    """Pieces of about PIECE_BYTES, cut only where a space is."""
    out, at = [], 0
    while len(raw) - at > PIECE_BYTES:
        arr = np.frombuffer(raw, np.uint8, offset=at + PIECE_BYTES)
        end = len(raw)
        for lo in range(0, len(arr), PIECE_BYTES):
            hit = np.flatnonzero(_SPACE[arr[lo:lo + PIECE_BYTES]])
            if len(hit):
                end = at + PIECE_BYTES + lo + int(hit[0])
                break
        out.append(raw[at:end])
        at = end
    out.append(raw[at:])
    return out


class Words:
    """Lower-cased (A-Z) words of some texts: ``hashes`` in text order,
    ``counts`` per text; ``heads`` hashes each word's first ``head`` bytes."""

    def __init__(self, texts: Sequence[str | None], head: int = 0):
        pieces: list[tuple[int, bytes]] = []
        for i, t in enumerate(texts):
            if t:
                raw = t.encode("utf-8", "surrogatepass")
                pieces += [(i, p) for p in (_split_long(raw) if len(raw) > PIECE_BYTES else [raw])]
        self.counts = np.zeros(len(texts), np.int64)
        hashes, heads, self._spans = [], [], []
        for group in _grouped(pieces):
            data = b"\n".join(p for _, p in group) + b"\n"
            low = _LOWER[np.frombuffer(data, np.uint8)]
            inside = ~_SPACE[low]
            step = np.diff(inside.view(np.int8), prepend=np.int8(0))
            starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            if not len(starts):
                continue
            lens = ends - starts
            at = np.flatnonzero(inside)
            pos = at - np.repeat(starts, lens)
            pw = _POW if lens.max() <= len(_POW) else powers(int(lens.max()))
            first = np.cumsum(lens) - lens
            with np.errstate(over="ignore"):
                part = (low[at].astype(np.uint64) + np.uint64(1)) * pw[pos]
                hashes.append(mix64(np.add.reduceat(part, first)
                                    + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
                if head:
                    heads.append(mix64(np.add.reduceat(
                        np.where(pos < head, part, np.uint64(0)), first)
                        + np.uint64(0xA0761D6478BD642F)))
            bounds = np.cumsum([0] + [len(p) + 1 for _, p in group])
            np.add.at(self.counts, [i for i, _ in group],
                      np.diff(np.searchsorted(starts, bounds)))
            self._spans.append((low, starts, ends))
        none = np.zeros(0, np.uint64)
        self.hashes = np.concatenate(hashes) if hashes else none
        self.heads = np.concatenate(heads) if heads else none
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def strings(self, at: np.ndarray) -> list[bytes]:
        """Bytes of the words numbered ``at`` (ascending)."""
        out, base = [], 0
        for low, starts, ends in self._spans:
            lo, hi = np.searchsorted(at, [base, base + len(starts)])
            own, raw = at[lo:hi] - base, low.tobytes()
            out += [raw[s:e] for s, e in zip(starts[own].tolist(), ends[own].tolist())]
            base += len(starts)
        return out


def _grouped(pieces: list[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    group, size = [], 0
    for p in pieces:
        if group and size + len(p[1]) > PIECE_BYTES:
            yield group
            group, size = [], 0
        group.append(p)
        size += len(p[1])
    if group:
        yield group


def as_int64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
