"""Approximate nearest neighbours by a hash-prefix forest.

Every tree hashes a vector to a long bit string: signs of random projections
of the centred vector. A tree is its sorted array of strings, cut into cells
by a directory of their first bits and, inside a cell, into blocks of bounded
size by a hash of the row. A query descends every tree to its longest matching
prefix and then ascends all trees together, one bit at a time: at prefix
length x its candidates are the contiguous runs of the sorted arrays that
share x bits with it in any tree. It stops when enough candidates have been
met. Distances to the candidates are exact, in double precision, on the
original vectors, and each block returns a query's nearest only.

How many candidates are enough is measured, not assumed: for a bounded hash
sample of stored vectors (``PROBES``), true neighbours are found by brute force
and the share of candidates is the smallest that reaches ``RECALL`` on them.

Equal vectors are one entry, which keeps its smallest row ids (one more than
the neighbours asked for, so that a query can leave out itself): a hot vector
costs one aggregate, and ties go to the smaller id exactly.

Defined cases: vectors that are null, empty, zero, of another length than most
or hold null or non-finite components take no part, nor do rows with a null
id; repeated ids are one row each; with fewer candidates than asked for, all
come back; without queries or vectors the result is empty; other columns are
unused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

TREES = 24
BITS = 62
NEIGHBOURS = 10
BLOCK = 4096                 # vectors of a block, about
QUERIES = 4096               # queries of a cell that meet its blocks at once, about
PROBES = 64                  # vectors whose true neighbours set the stop
RECALL = 0.96
SEED = 7


def _planes(dims: int, trees: int, bits: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims, trees * bits))


def hash_strings(x: np.ndarray, centre: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """(n, trees) bit strings as integers, the first bit the most significant."""
    signs = ((x - centre) @ _planes(x.shape[1], trees, bits) > 0).reshape(len(x), trees, bits)
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64))


def bit_length(x: np.ndarray) -> np.ndarray:
    """Bits of non-negative integers; exact, since both halves fit a double."""
    high = x >> 31
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 31, np.frexp((x & 0x7FFFFFFF).astype(np.float64))[1])


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list<double> column of one length."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()),
                                    pa.array(x.ravel()))


def _nearest(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
    """For each query row, the k entries of x nearest to it that are not its
    own entry, ties to the smaller id: indices and distances. The matrix
    product only preselects; distances come from the differences."""
    rough = (x * x).sum(1)[None, :] - 2.0 * (q @ x.T)
    rough[own[:, None] == ids[None, :]] = np.inf
    if len(x) > 4 * k:
        bar = np.partition(rough, k - 1, axis=1)[:, k - 1]
    else:
        bar = np.full(len(q), np.inf)
    slack = 1e-9 * (1.0 + np.abs(np.where(np.isfinite(bar), bar, 0)) + (q * q).sum(1))
    for i in range(len(q)):
        at = np.flatnonzero((rough[i] <= bar[i] + slack[i]) & np.isfinite(rough[i]))
        d = np.sqrt(((x[at] - q[i]) ** 2).sum(1))
        by = np.lexsort((ids[at], d))[:k]
        yield at[by], d[by]


def entries(vectors: DataFrame, id_col: str, vector_col: str, keep: int) -> DataFrame:
    """(entry, v, ids): distinct vectors that take part, with their ``keep``
    smallest row ids; ``entry`` is the smallest id."""
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & (F.size(v) > 0) \
        & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))) \
        & F.exists(v, lambda e: e != 0.0)
    # -0.0 and 0.0 are one value
    rows = vectors.where(F.col(id_col).isNotNull()).where(fine).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda e: e + F.lit(0.0)).alias("v"))
    key = F.sha2(F.to_json(F.struct("v")), 256)
    named = rows.select("id", "v", key.alias("key"))
    # smallest ids first within salted parts of a hot vector, then over them
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    part = named.groupBy("key", salt.alias("salt")).agg(
        F.slice(F.array_sort(F.collect_set("id")), 1, keep).alias("ids"), F.min("id").alias("entry"))
    whole = part.groupBy("key").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"),
        F.min("entry").alias("entry"))
    pick = named.select(F.col("id").alias("entry"), "key", "v").dropDuplicates(["entry", "key"])
    return whole.join(pick.hint("merge"), ["key", "entry"]).select("entry", "v", "ids")


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding",
           k: int = NEIGHBOURS, trees: int = TREES, bits: int = BITS, probes: int = PROBES,
           recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for the rows
    that ``queries`` selects, against all other rows."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    e = cut(entries(vectors, id_col, vector_col, k + 1), "ann-entries")
    sizes = e.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], result)
    dims = sizes["d"]
    e = e.where(F.size("v") == dims)
    n = e.count()
    # one row of ``dims`` numbers
    centre = np.array(e.agg(F.array(*[F.avg(F.col("v")[i]) for i in range(dims)]).alias("m")).first()["m"])
    depth = max(0, min(bits, (max(n, 1) // BLOCK).bit_length()))      # bits of the directory

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = hash_strings(_matrix(b.column(1)), centre, trees, bits)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(h)],
                                             names=["entry", "v", "h"])
    hashed = cut(e.select("entry", "v").mapInArrow(strings, "entry long, v array<double>, h array<long>"),
                 "ann-strings")
    wanted = vectors.where(queries & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("_v")).distinct()
    # a query's entry is found by its vector
    wanted = cut(wanted.where(F.size("_v") == dims)
                 .withColumn("_v", F.transform("_v", lambda x: x + F.lit(0.0)))
                 .join(hashed.hint("merge"), F.col("_v") == F.col("v"))
                 .select("query_id", "entry", "v", "h"), "ann-queries")

    share = _stop_share(hashed, n, k, trees, bits, probes, recall)
    need = int(np.ceil(share * n * trees))          # entries met over all trees, repeats counted

    trees_of = F.posexplode("h").alias("tree", "key")
    cell = F.shiftright("key", bits - depth).alias("cell") if depth else F.lit(0).cast("long").alias("cell")
    placed = hashed.select("entry", "v", trees_of).select("entry", "v", "tree", "key", cell)
    # entries below a prefix, per tree and length, for the directory's lengths
    filled = cut(placed.groupBy("tree", "cell").agg(F.count("*").alias("n")), "ann-cells")
    below = None
    asked = wanted.select("query_id", "entry", "v", trees_of).select(
        "query_id", "entry", "v", "tree", "key", cell)
    for x in range(depth + 1):
        up = F.shiftright("cell", depth - x).alias("prefix")
        level = filled.groupBy("tree", up).agg(F.sum("n").alias("n")).withColumn("x", F.lit(x))
        below = level if below is None else below.unionByName(level)
    met = asked.select("query_id", "tree", "cell", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("x")) \
        .withColumn("prefix", F.expr(f"shiftright(cell, {depth} - x)")) \
        .join(below, ["tree", "x", "prefix"]).select("query_id", "x", "n")
    # longer prefixes, inside the query's own cell of every tree
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    group = ["tree", "cell", "block", "part"]

    def met_by(asking: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Blocks and the queries that meet them: a cell's queries are dealt to
        parts of bounded size, its blocks are sent once to each of its parts,
        and cells that no query asks for are not sent."""
        many = cut(asking.groupBy("tree", "cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
                   .join(filled, ["tree", "cell"]), "ann-parts")        # one row a cell
        sent = placed.join(many, ["tree", "cell"]) \
            .withColumn("block", F.pmod(F.xxhash64("entry"), n_blocks.cast("long")).cast("int")) \
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = asking.join(many, ["tree", "cell"]) \
            .withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")) \
            .withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        return sent, dealt

    def deeper(key, points: pa.Table, qs: pa.Table) -> pa.Table:
        p = np.sort(points["key"].to_numpy())
        q, ids = qs["key"].to_numpy(), qs["query_id"].to_numpy()
        out_q, out_x, out_n = [], [], []
        for x in range(depth + 1, bits + 1):
            lo = (q >> (bits - x)) << (bits - x)
            c = np.searchsorted(p, lo + (1 << (bits - x))) - np.searchsorted(p, lo)
            hit = c > 0
            if not hit.any():
                break
            out_q.append(ids[hit])
            out_n.append(c[hit])
            out_x.append(np.full(hit.sum(), x, np.int32))
        cat = lambda a, t: np.concatenate(a).astype(t) if a else np.zeros(0, t)
        return pa.table({"query_id": cat(out_q, np.int64), "x": cat(out_x, np.int32),
                         "n": cat(out_n, np.int64)})

    sent, inside = met_by(asked)
    deep = sent.select(*group, "key").groupBy(*group).cogroup(
        inside.select(*group, "query_id", "key").groupBy(*group)
    ).applyInArrow(deeper, "query_id long, x int, n long")
    # synchronous ascent: the longest prefix at which enough has been met
    level = met.unionByName(deep).groupBy("query_id", "x").agg(F.sum("n").alias("n")) \
        .groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("n") >= need, F.col("x"))), F.lit(0)).alias("x"))
    level = cut(level, "ann-levels")

    # the runs of the sorted arrays that share x bits: whole cells, or part of one
    wide = asked.join(level.hint("merge"), "query_id") \
        .withColumn("up", F.greatest(F.lit(depth) - F.col("x"), F.lit(0))) \
        .withColumn("lo", F.expr("shiftleft(shiftright(cell, up), up)")) \
        .withColumn("cell", F.explode(F.expr("sequence(lo, lo + shiftleft(1L, up) - 1)")))
    sent, dealt = met_by(wide)
    wide = dealt.select(*group, "query_id", "entry", "v", "key", "x")

    def rank(key, points: pa.Table, qs: pa.Table) -> pa.Table:
        x = _matrix(points["v"].combine_chunks()) if points.num_rows else np.zeros((0, dims))
        pk, pid = points["key"].to_numpy(), points["entry"].to_numpy()
        by = np.argsort(pk, kind="stable")
        x, pk, pid = x[by], pk[by], pid[by]
        out = []
        if len(pk) and qs.num_rows:
            qv, qk = _matrix(qs["v"].combine_chunks()), qs["key"].to_numpy()
            own, ids, lev = (qs[c].to_numpy() for c in ("entry", "query_id", "x"))
            shift = bits - lev.astype(np.int64)
            lo = (qk >> shift) << shift
            a, e_ = np.searchsorted(pk, lo), np.searchsorted(pk, lo + (np.int64(1) << shift))
            order = np.lexsort((e_, a))
            start = 0
            while start < len(order):             # queries with one run share a product
                i = order[start]
                stop = start
                while stop < len(order) and a[order[stop]] == a[i] and e_[order[stop]] == e_[i] \
                        and stop - start < 256:
                    stop += 1
                q = order[start:stop]
                if e_[i] > a[i]:
                    part = slice(a[i], e_[i])
                    for j, (at, d) in zip(q, _nearest(qv[q], x[part], own[q], pid[part], k)):
                        out += [(int(ids[j]), int(pid[part][m]), float(s)) for m, s in zip(at, d)]
                start = stop
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "entry": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    found = sent.select(*group, "entry", "v", "key").groupBy(*group).cogroup(
        wide.groupBy(*group)).applyInArrow(rank, "query_id long, entry long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "entry")
    near = found.distinct().withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")
    # a query's own vector may have other rows
    own = wanted.select("query_id", "entry", F.lit(0.0).alias("score"))
    rows = near.unionByName(own).join(e.select("entry", "ids").hint("merge"), "entry") \
        .select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return rows.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _stop_share(hashed: DataFrame, n: int, k: int, trees: int, bits: int, probes: int,
                recall: float) -> float:
    """Share of all tree entries to meet before the ascent stops: for a hash
    sample of about ``probes`` vectors, the true neighbours and the prefix
    lengths at which the trees hold them, against the run lengths there."""
    spark = hashed.sparkSession
    if n <= max(4 * k, 64):
        return 1.0
    rows = hashed.where(F.pmod(F.xxhash64(F.lit(3), "entry"), F.lit(n)) < probes).select("entry", "v", "h")
    sample = rows.toArrow()                       # about ``probes`` rows
    if not sample.num_rows:
        return 1.0
    q, qh, own = (_matrix(sample["v"].combine_chunks()), _matrix(sample["h"].combine_chunks()),
                  sample["entry"].to_numpy())
    sent = spark.sparkContext.broadcast((q, qh, own))

    def shared(h: np.ndarray, i: int, qh: np.ndarray) -> np.ndarray:
        """Longest prefix each row shares with probe i in any tree, and in all."""
        return bits - bit_length(h ^ qh[i])

    def run(batches):
        q, qh, own = sent.value
        counts = np.zeros((len(q), bits + 1), np.int64)
        for b in batches:
            x, h, ids = _matrix(b.column(1)), _matrix(b.column(2)), b.column(0).to_numpy()
            out = []
            for i, (at, d) in enumerate(_nearest(q, x, own, ids, k)):
                p = shared(h, i, qh)
                counts[i] += np.bincount(p.ravel(), minlength=bits + 1)
                out += [(i, int(p[j].max()), float(s), 0) for j, s in zip(at, d)]
            yield _probe_rows(out)
        yield _probe_rows([(int(i), int(x), -1.0, int(counts[i, x])) for i, x in zip(*np.nonzero(counts))])

    def _probe_rows(rows):
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.int32(), pa.int32(), pa.float64(), pa.int64()))], names=["i", "x", "d", "n"])
    got = hashed.mapInArrow(run, "i int, x int, d double, n long")
    near = Window.partitionBy("i").orderBy("d", F.desc("x"))
    true = got.where("d >= 0").withColumn("r", F.row_number().over(near)).where(F.col("r") <= k) \
        .select("i", "x").toArrow()               # k rows a probe
    runs = got.where("d < 0").groupBy("i", "x").agg(F.sum("n").alias("n")).toArrow()
    at_least = np.zeros((len(q), bits + 1))
    at_least[runs["i"].to_numpy(), runs["x"].to_numpy()] = runs["n"].to_numpy()
    at_least = at_least[:, ::-1].cumsum(1)[:, ::-1]       # entries with a prefix of x or longer
    # entries met when a neighbour is first met; the recall-quantile of that
    met = np.sort(at_least[true["i"].to_numpy(), true["x"].to_numpy()])
    return float(min(1.0, met[int(np.ceil(recall * len(met))) - 1] / (n * trees))) if len(met) else 1.0
