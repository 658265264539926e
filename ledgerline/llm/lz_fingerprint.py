"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: each phrase is the shortest string
from the current place that is not yet in the text's dictionary, and joins it.
The phrases are hashed and the smallest distinct hashes are the fingerprint;
two fingerprints are compared by the minimum-hash estimate of the Jaccard
index of the phrase sets, which behaves like a compression distance.

``edited`` compares each document with its text after the second half was
replaced by the start of the next document by id, and with that next document.
Rows are dealt out once, by ranges of the id; the first row of a range is also
sent to the range before it (the last range gets the first row of all), and a
task streams through its ranges holding two documents at a time. Bounds of the
ranges come from a quantile sketch over the ids; they only place the cuts.

Defined cases: a null text is empty; an empty fingerprint is like another
empty one (1) and unlike any other (0); rows with equal ids follow each other
by the hash of the text; null ids come last; a single row is followed by
itself; an empty table gives an empty result; other columns are unused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, mix64, powers, small_batches

SIZE = 256                   # hashes of a fingerprint, 32 bits each
_INVERSE = pow(_BASE, -1, 1 << 64)


def parse(text: str, start: int, seen: set[str]) -> tuple[list[str], list[int]]:
    """Phrases from ``start`` on and their ends; ``seen`` is extended.

    The dictionary holds every prefix of its phrases, so the shortest new
    string can be approached from the last phrase's length, from either side.
    A rest that is in the dictionary already adds no phrase.
    """
    phrases, ends = [], []
    n, g = len(text), 3
    add, put, mark = seen.add, phrases.append, ends.append
    while start < n:
        e = start + g
        if e > n:
            e = n
        piece = text[start:e]
        if piece in seen:
            while e < n:
                e += 1
                piece = text[start:e]
                if piece not in seen:
                    break
            else:
                break
        else:
            while e - start > 1:
                shorter = text[start:e - 1]
                if shorter in seen:
                    break
                piece = shorter
                e -= 1
        add(piece)
        put(piece)
        mark(e)
        g = e - start
        start = e
    return phrases, ends


class Hasher:
    """64-bit hashes of many spans of one text from prefix sums; the tables
    grow to the longest text a task has met."""

    def __init__(self):
        self.pow, self.inv = powers(1 << 14), self._inverse(1 << 14)

    @staticmethod
    def _inverse(n: int) -> np.ndarray:
        p = np.full(n, _INVERSE, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(p)

    def spans(self, text: str, ends: list[int], first: int) -> np.ndarray:
        """Hashes of text[first:ends[0]], text[ends[0]:ends[1]], ..."""
        if not ends:
            return np.zeros(0, np.uint64)
        code = np.frombuffer(text[first:ends[-1]].encode("utf-32-le", "surrogatepass"), "<u4")
        if len(code) >= len(self.pow):
            n = 2 * len(code)
            self.pow, self.inv = powers(n), self._inverse(n)
        with np.errstate(over="ignore"):
            total = np.zeros(len(code) + 1, np.uint64)
            np.cumsum((code.astype(np.uint64) + np.uint64(1)) * self.pow[:len(code)], out=total[1:])
            e = np.array(ends, np.int64) - first
            s = np.concatenate([[0], e[:-1]])
            return mix64((total[e] - total[s]) * self.inv[s]
                         + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def smallest(hashes: np.ndarray, size: int) -> np.ndarray:
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard index: the share of the smallest ``size`` hashes of
    the union that both hold; exact for sets of up to ``size`` phrases."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = np.append(both[1:] == both[:-1], False)
    first = np.append(True, both[1:] != both[:-1])
    k = min(size, int(first.sum()))
    return float(twice[first][:k].sum() / k)


def as_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, fingerprint) per row, without any shuffle."""
    small_batches(docs.sparkSession)

    def run(batches):
        hasher = Hasher()
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([as_hex(smallest(hasher.spans(t, parse(t, 0, set())[1], 0), size))
                           for t in texts], pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


class _Doc:
    def __init__(self, doc_id, text, hasher: Hasher, size: int):
        self.id, self.text = doc_id, text or ""
        self.phrases, self.ends = parse(self.text, 0, set())
        self.hashes = hasher.spans(self.text, self.ends, 0)
        self.sig = smallest(self.hashes, size)

    def edit(self, follower: _Doc, hasher: Hasher, size: int) -> tuple[str, np.ndarray]:
        """The edited text and its fingerprint; the phrases that end before
        the edit are those of the text itself and are not parsed again."""
        half = len(self.text) // 2
        cut = len(self.text) - half
        text = self.text[:cut] + follower.text[:half]
        k = int(np.searchsorted(self.ends, cut, "right"))
        at = self.ends[k - 1] if k else 0
        _, ends = parse(text, at, set(self.phrases[:k]))
        return text, smallest(np.concatenate([self.hashes[:k], hasher.spans(text, ends, at)]), size)


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row per row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * 2
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 20 * n)
                    .alias("q")).first()["q"] or []
    bounds = np.unique(np.array(cuts, np.int64))
    last = len(bounds) + 1                       # range of the null ids

    @F.pandas_udf("long")
    def range_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(ids.isna(), last, at))

    placed = rows.withColumn("range", range_of("doc_id"))
    # one row per range: at most twice the shuffle partitions
    heads = rows.select("doc_id").withColumn("range", range_of("doc_id")).groupBy("range") \
        .agg(F.min("doc_id").alias("head")).orderBy("range").collect()
    if not heads:
        heads = []
    before = {h["range"]: heads[i - 1]["range"] for i, h in enumerate(heads)}
    table = spark.createDataFrame([(h["range"], h["head"], before[h["range"]]) for h in heads],
                                  "range long, head long, before long")
    own = F.struct(F.col("range"), F.lit(0).alias("follows"))
    sent = placed.join(F.broadcast(table), "range").select("doc_id", "text", F.explode(
        F.when(F.col("doc_id").eqNullSafe(F.col("head")),
               F.array(own, F.struct(F.col("before").alias("range"), F.lit(1).alias("follows"))))
        .otherwise(F.array(own))).alias("to"))
    dealt = sent.select(F.col("to.range").alias("range"), F.col("to.follows").alias("follows"),
                        "doc_id", "text") \
        .repartition(n, "range") \
        .sortWithinPartitions("range", "follows", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        held, held_range, closed = None, None, None
        for b in batches:
            out = []
            for rng, follows, doc_id, text in zip(*[c.to_pylist() for c in b.columns]):
                if follows and closed == rng:
                    continue                      # only the first follower counts
                doc = _Doc(doc_id, text, hasher, size)
                if held is not None and held_range == rng:
                    new, sig = held.edit(doc, hasher, size)
                    out.append((held.id, len(held.text),
                                hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                                as_hex(held.sig), as_hex(sig), likeness(held.sig, sig, size),
                                likeness(held.sig, doc.sig, size)))
                held, held_range = (None, None) if follows else (doc, rng)
                closed = rng if follows else None
            cols = list(zip(*out)) if out else [()] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                                    "edited_fingerprint", "near_edited", "near_next"])
    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, "
                                 "fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")
