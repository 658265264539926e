"""Ranked lexical search over a length-stratified index.

Documents with an equal length normaliser m form a stratum. Inside a stratum a
term's postings are grouped by tf, so a posting's impact,
(1000000000 * tf) div (1000 * tf + 20 * m), is computed once per tf and not per
document, and the largest tf bounds what the term can add to any document of
the stratum. The sum of these bounds over an item's terms bounds its stratum.

* ``build`` reads every text once, counts its terms, and keeps those that the
  query set asks for; N, L and df are aggregates over all documents. Rows are
  range-sorted by (m, hash), so that a stratum of any size is cut into slices
  of bounded size, and each slice is inverted into one index row.
* ``search`` visits the strata in the order of their bounds, in two rounds.
  The first takes, per item, the strata of the highest bounds until they hold
  FIRST documents; the item's k-th best score there is a threshold. The second
  visits the rest whose bound reaches the threshold. A slice left out cannot
  hold a document of the result, so the result is exact.

The query set is taken in blocks of about PAIRS (item, term) pairs; a block's
weights are the only data sent to all tasks. Tasks keep k rows per item.

Defined cases: null, empty and term-free texts count in nothing and are never
found; an item without terms, or whose terms no document holds, has no rows;
rows of one item_id are one item with all their terms; a null item_id is an
item like another; a null doc_id ranks after others of its score; repeated
documents are found once each; scores that tie with the k-th are taken by
ascending doc_id; texts of any length are counted piece by piece; empty tables
give no rows; other columns are unused and may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")        # of bytes with A-Z lower-cased
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
PIECE = 1 << 22              # bytes of one text counted at once
PAIRS = 1 << 18              # (item, term) pairs of a block of the query set
SLICE_DOCS = 4096            # documents of an index row, at most
SLICE_POSTINGS = 1 << 18     # and postings, unless one document has more
FIRST = 2000                 # documents of the first round's strata, per item
SPREAD = 1 << 18             # score additions made at once
K = 50


def count_terms(raw: bytes) -> Counter:
    """Terms of a text (UTF-8) with their numbers of occurrences."""
    out: Counter = Counter()
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > PIECE:
            hit = BREAK.search(raw, at + PIECE)
            end = hit.start() if hit else end
        out.update(TERM.findall(raw[at:end].lower()))
        at = end
    return out


def asked_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item_id, term) of the query set."""
    def run(batches):
        for b in batches:
            ids, terms = [], []
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = list(count_terms(raw or b""))
                ids += [i] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())],
                                             names=["item_id", "term"])
    return items.select(F.col(id_col).cast("long").alias("item_id"),
                        F.col(text_col).cast("binary").alias("raw")) \
        .mapInArrow(run, "item_id long, term binary").distinct()


class Block:
    """One block of the query set: items, their terms' numbers, and weights."""

    def __init__(self, pairs: list[tuple[int | None, bytes]]):
        self.items = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
        terms = sorted({t for _, t in pairs})
        self.number = {t: k for k, t in enumerate(terms)}
        place = {i: k for k, i in enumerate(self.items)}
        by_term: list[list[int]] = [[] for _ in terms]
        for i, t in pairs:
            by_term[self.number[t]].append(place[i])
        self.many = np.array([len(x) for x in by_term], np.int64)      # items of each term
        self.start = np.cumsum(self.many) - self.many
        self.item = np.array([i for x in by_term for i in sorted(x)], np.int64)
        self.weight = np.zeros(len(terms), np.int64)

    def weigh(self, docs: int, df: dict[int, int]) -> None:
        for t, n in df.items():
            self.weight[t] = math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1)))

    def spread(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``terms``, item) of every pair of a term and its items."""
        many = self.many[terms]
        at = np.repeat(np.arange(len(terms)), many)
        inside = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        return at, self.item[self.start[terms[at]] + inside]


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def counted(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) per row: all terms counted, asked ones listed."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        known = shared.value
        keys = known.keys()
        for b in batches:
            n, at, terms, tfs = [], [0], [], []
            for raw in b.column(1):
                c = count_terms(raw.as_py() or b"")
                own = c.keys() & keys
                terms += map(known.__getitem__, own)
                tfs += map(c.__getitem__, own)
                n.append(c.total())
                at.append(len(terms))
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("raw")) \
        .mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


SLICE = "m long, docs array<long>, term array<int>, tf array<long>, ends array<int>, doc array<int>"


def inverted(rows: DataFrame) -> DataFrame:
    """Slices of strata from rows (m, doc_id, terms, tfs) sorted by m. A slice
    holds runs of postings of one (term, tf), in that order."""
    names = [x.split()[0] for x in SLICE.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.list_(pa.int32())]

    def slice_of(m, docs, terms, tfs):
        t, f = np.concatenate(terms), np.concatenate(tfs)
        d = np.repeat(np.arange(len(docs), dtype=np.int32), [len(x) for x in terms])
        order = np.lexsort((d, f, t))
        t, f, d = t[order], f[order], d[order]
        last = np.flatnonzero(np.append((t[1:] != t[:-1]) | (f[1:] != f[:-1]), True))
        return m, docs, t[last], f[last], (last + 1).astype(np.int32), d

    def run(batches):
        held, size, at = ([], [], []), 0, None
        for b in batches:
            out = []
            values = [(c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy())
                      for c in b.columns[2:]]
            for k, (m, doc) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                t, f = (v[o[k]:o[k + 1]] for v, o in values)
                if held[0] and (m != at or len(held[0]) >= SLICE_DOCS or size + len(t) > SLICE_POSTINGS):
                    out.append(slice_of(at, *held))
                    held, size = ([], [], []), 0
                at = m
                for x, y in zip(held, (doc, t, f)):
                    x.append(y)
                size += len(t)
            if out:
                yield _slices(out)
        if held[0]:
            yield _slices([slice_of(at, *held)])

    def _slices(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    return rows.select("m", "doc_id", "terms", "tfs").mapInArrow(run, SLICE)


def build(docs: DataFrame, block: Block, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of ``docs`` for the terms of ``block``, a written table, one
    row per slice of a stratum; sets the block's weights."""
    spark = docs.sparkSession
    c = cut(counted(docs, block.number, id_col, text_col), "lexical-terms")
    s = c.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("all")).first()
    # one row per asked term: bounded by the block
    df = c.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    block.weigh(s["docs"], {r["t"]: r["count"] for r in df})
    m = F.expr(f"50L + (50L * n * {s['docs']}L) div {s['all'] or 1}L")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spot = F.xxhash64("doc_id", "terms", "tfs")
    rows = (c.where(F.size("terms") > 0).withColumn("m", m)
            .repartitionByRange(n, "m", spot).sortWithinPartitions("m", spot))
    return cut(inverted(rows), "lexical-index")


def _best(score, doc, gone, k):
    order = np.lexsort((doc, gone, -score))[:k]
    return score[order], doc[order], gone[order]


def visit(index: DataFrame, block: Block, low: np.ndarray, high: np.ndarray | None,
          least: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): per task and item the k best documents of the
    slices whose bound is at least ``low`` and below ``high``; scores below
    ``least`` are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        top = {}                                        # item -> (score, doc, is null)
        floor = np.maximum(least, 1)
        for b in batches:
            for r in range(b.num_rows):
                m = b.column(0)[r].as_py()
                ids, term, tf, ends, doc = (b.column(c)[r].values for c in range(1, 6))
                gone = np.array(ids.is_null())
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                term, tf, ends, doc = (x.to_numpy() for x in (term, tf, ends, doc))
                imp = impact(tf, m)                     # once per tf of a term
                last = np.flatnonzero(np.append(term[1:] != term[:-1], True))
                at, item = block.spread(term[last])
                bound = np.zeros(len(block.items), np.int64)
                np.add.at(bound, item, block.weight[term[last][at]] * imp[last][at])
                take = (bound >= low) & (bound >= floor)
                if high is not None:
                    take &= bound < high
                asked = np.flatnonzero(take)
                if not len(asked):
                    continue
                place = np.full(len(take), -1)
                place[asked] = np.arange(len(asked))
                at, item = block.spread(term)           # runs x items
                own = place[item] >= 0
                at, row = at[own], place[item[own]]
                add = block.weight[term[at]] * imp[at]
                many = np.diff(ends, prepend=0)
                first = ends - many
                score = np.zeros((len(asked), len(ids)), np.int64)
                flat, width, step = score.ravel(), many[at], np.cumsum(many[at])
                lo = 0
                while lo < len(at):                     # a bounded number of additions at once
                    hi = max(lo + 1, int(np.searchsorted(step, step[lo] - width[lo] + SPREAD, "right")))
                    w = width[lo:hi]
                    run_ = np.repeat(np.arange(lo, hi), w)
                    inside = np.arange(len(run_)) - np.repeat(np.cumsum(w) - w, w)
                    np.add.at(flat, row[run_] * len(ids) + doc[first[at[run_]] + inside], add[run_])
                    lo = hi
                reach = score.max(axis=1) >= floor[asked]
                for j in np.flatnonzero(reach):
                    q = asked[j]
                    hit = np.flatnonzero(score[j] >= floor[q])
                    old = top.get(q, (none, none, none.astype(bool)))
                    top[q] = _best(*(np.concatenate(x) for x in zip(
                        old, (score[j][hit], ids[hit], gone[hit]))), k)
                    if len(top[q][0]) == k:
                        floor[q] = max(floor[q], top[q][0][-1])
        if top:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(top), [len(x[0]) for x in top.values()]), pa.int32()),
                 pa.array(np.concatenate([x[1] for x in top.values()]), pa.int64(),
                          mask=np.concatenate([x[2] for x in top.values()])),
                 pa.array(np.concatenate([x[0] for x in top.values()]), pa.int64())],
                names=["item", "doc_id", "score"])
    return index.mapInArrow(run, "item int, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """Adds ``rank`` and keeps the k best of each item; Spark keeps k rows an
    item and task before the shuffle."""
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def first_bounds(index: DataFrame, block: Block, first: int) -> np.ndarray:
    """Per item the bound down to which its strata, in descending order of
    bounds, hold ``first`` documents."""
    spark = index.sparkSession
    sizes = index.groupBy("m").agg(F.sum(F.size("docs")).alias("docs"))
    most = (index.select("m", F.explode(F.arrays_zip("term", "tf")).alias("p"))
            .groupBy("m", F.col("p.term").alias("term")).agg(F.max("p.tf").alias("tf"))
            .withColumn("top", F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)")))
    at, item = block.spread(np.arange(len(block.weight)))
    pairs = spark.createDataFrame(pa.table({"term": pa.array(at, pa.int32()), "item": pa.array(item, pa.int32()),
                                            "w": pa.array(block.weight[at], pa.int64())}))
    bounds = (most.join(pairs, "term").groupBy("item", "m").agg(F.sum(F.col("w") * F.col("top")).alias("bound"))
              .where("bound > 0").join(sizes, "m"))
    before = Window.partitionBy("item").orderBy(F.col("bound").desc(), "m").rowsBetween(
        Window.unboundedPreceding, -1)
    got = (bounds.withColumn("_before", F.coalesce(F.sum("docs").over(before), F.lit(0)))
           .where(F.col("_before") < first).groupBy("item").agg(F.min("bound").alias("bound")))
    out = np.ones(len(block.items), np.int64)
    for r in got.collect():
        out[r["item"]] = r["bound"]
    return out


def search_block(index: DataFrame, block: Block, k: int = K, first: int = FIRST) -> DataFrame:
    """(item, doc_id, score, rank) of a block of the query set."""
    high = first_bounds(index, block, first)
    none = np.zeros(len(block.items), np.int64)
    one = cut(ranked(visit(index, block, high, None, none, k), k), "lexical-first")
    least = none.copy()
    for r in one.where(F.col("rank") == k).collect():
        least[r["item"]] = r["score"]
    two = visit(index, block, least, high, least, k)
    return ranked(one.drop("rank").unionByName(two), k)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", k: int = K, first: int = FIRST,
           pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents."""
    spark = docs.sparkSession
    asked = cut(asked_terms(items, item_col, item_text), "lexical-asked")
    blocks = max(1, -(-asked.count() // pairs))
    part = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = None
    for b in range(blocks):
        block = Block([tuple(r) for r in asked.where(part == b).collect()])
        if not block.items:
            continue
        names = spark.createDataFrame(
            pa.table({"item": pa.array(range(len(block.items)), pa.int32()),
                      "item_id": pa.array(block.items, pa.int64())}))
        got = (search_block(build(docs, block, id_col, text_col), block, k, first)
               .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        got = cut(got, "lexical-found") if blocks > 1 else got
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
