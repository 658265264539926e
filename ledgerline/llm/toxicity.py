"""Toxic passages by maximum-scoring segments.

Training counts the toxic and clean labelled documents that hold a token. A token's score
is the log-odds of its posterior toxic share against the base share, under a
Dirichlet prior whose mean is the posterior share of all tokens with the same
first letters, itself under a prior at the base rate: rare and unseen word
forms lean on their stem, and tokens seen once stay near zero. A text's
maximal scoring segments (Ruzzo and Tompa, linear time) are its passages. The
score of the best segment of a clean text of n tokens, less ln n, follows an
extreme-value (Gumbel) law; its location and scale are fitted by quantiles on
clean labelled texts that did not enter the counts. Segments are aggregated by the sum statistic of their
expected numbers, and a logistic curve fitted on the same held texts turns
that into a probability.

Bounds: the counts live in 2^20 hashed token cells and 2^20 hashed stem cells
whatever the input, and at most about ``MAX_LABELLED`` labelled documents
(a uniform hash sample, the documented bound of the classifier) are used.
Every document is scored whole.

Defined cases: a null, empty or blank text has no segment and scores by the
fitted curve at the lowest evidence; rows with a null label or id train
nothing; repeated rows score alike; without labels of both classes every
document scores 0; an empty table gives an empty result; other columns are
unused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, cut, small_batches

CELL_BITS = 20
STEM_BYTES = 4
TOKEN_PRIOR = 4.0            # pseudo-counts behind a token's share
STEM_PRIOR = 10.0            # pseudo-counts behind a stem's share
NOISE = 1.0                  # log-odds below this are background
STEP = -0.05                 # background score: the drift between passages
MAX_LABELLED = 200_000
FLOOR, CEIL, BIN = -20.0, 200.0, 0.25
CURVE = (-3.0, 20.0)         # the curve is flat outside
THRESHOLD = 0.3


@dataclass
class Model:
    toxic: np.ndarray        # toxic documents by token cell
    total: np.ndarray
    stem_share: np.ndarray   # posterior toxic share by stem cell
    base: float              # toxic share of all counts
    rate: float = 1.0        # extreme-value rate
    place: float = 0.0       # rate times location
    slope: float = 1.0
    shift: float = 0.0


def fold(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def token_scores(m: Model, w: Words) -> np.ndarray:
    cell, stem = _cells(w.hashes), _cells(w.heads)
    prior = m.stem_share[stem]
    share = (m.toxic[cell] + TOKEN_PRIOR * prior) / (m.total[cell] + TOKEN_PRIOR)
    share = np.clip(share.astype(np.float64), 1e-4, 1 - 1e-3)
    s = np.log(share / (1 - share)) - np.log(m.base / (1 - m.base))
    return np.where(s > NOISE, s, np.minimum(s, STEP))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end), in linear time.

    A candidate list is kept with the running totals left and right of each
    candidate; a new positive run either starts a candidate or merges back to
    the nearest candidate with a smaller left total and not larger right one.
    """
    pos = scores > 0
    if not pos.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    step = np.diff(pos.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    found: list[list] = []               # [start, end, left, right, index of nearest lower left]
    for s, e in zip(starts.tolist(), ends.tolist()):
        new = [s, e, total[s], total[e], -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            new[4] = j
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], found[j][4]]
            del found[j:]
    return [(s, e, float(r - l)) for s, e, l, r, _ in found]


def surprise(m: Model, score: float | np.ndarray, n: int) -> float | np.ndarray:
    """-ln of the expected number of segments so good in a clean text of n."""
    return m.rate * (score - np.log(max(n, 1))) - m.place


def evidence(m: Model, seg: list[tuple[int, int, float]], n: int) -> float:
    """Sum statistic: segments with expected number E < 1 in a clean text of n
    tokens add -ln E each, less ln r! for their order; without any, the best
    segment's (negative) -ln E."""
    if not seg:
        return FLOOR
    x = np.sort(surprise(m, np.array([s for _, _, s in seg]), n))[::-1]
    strong = x[x > 0]
    if not len(strong):
        return float(max(FLOOR, x[0]))
    sums = np.cumsum(strong) - np.cumsum(np.log(np.arange(1, len(strong) + 1)))
    return float(min(CEIL, max(sums.max(), x[0])))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
              max_labelled: int) -> DataFrame:
    """(fold, toxic, text) of a uniform sample of the training labels; the
    sample's bound makes its broadcast safe at any input size."""
    train = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                         & (fold(F.col("doc_id"), 4) != 2)) \
        .select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_y"))
    n = train.count()
    if n > max_labelled:
        train = train.where(F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(1_000_000))
                            < int(1_000_000 * max_labelled / n))
    train = train.groupBy("_id").agg(F.max("_y").alias("_y"))
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")) \
        .join(F.broadcast(train), "_id") \
        .select(fold(F.col("_id"), 4).cast("int").alias("fold"), "_y", "_text")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by token and stem cell and class; stems follow tokens."""
    size = 1 << CELL_BITS
    acc = np.zeros((2, 2 * size), np.int64)
    for b in batches:
        w = Words(b.column(1).to_pylist(), head=STEM_BYTES)
        y = np.array(b.column(0).to_pylist(), np.int64)
        doc = np.repeat(np.arange(b.num_rows), w.counts) << CELL_BITS
        for h, base in ((w.hashes, 0), (w.heads, size)):
            once = np.unique(doc | _cells(h))           # a document counts a cell once
            cell, toxic = once & (size - 1), y[once >> CELL_BITS] == 1
            for c in (0, 1):
                np.add.at(acc[c], base + cell[toxic == c], 1)
    at = np.flatnonzero(acc.any(0))
    for lo in range(0, len(at), 1 << 16):
        part = at[lo:lo + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(acc[0, part]),
                                          pa.array(acc[1, part])], names=["cell", "clean", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_labelled: int = MAX_LABELLED) -> Model | None:
    """Counts from folds 0 and 1, calibration from fold 3, of the labelled
    rows; fold 2 is never read. The driver receives at most 2^21 count rows
    and a histogram of fixed width."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = _labelled(docs, labels, id_col, text_col, max_labelled)
    got = rows.where("fold <> 3").select("_y", "_text").mapInArrow(
        _counts, "cell long, clean long, toxic long").groupBy("cell").agg(
        F.sum("clean").cast("int").alias("clean"), F.sum("toxic").cast("int").alias("toxic")).toArrow()
    size = 1 << CELL_BITS
    n0, n1 = np.zeros(2 * size, np.float32), np.zeros(2 * size, np.float32)
    cell = got["cell"].to_numpy()
    n0[cell], n1[cell] = got["clean"].to_numpy(), got["toxic"].to_numpy()
    if not n0[:size].sum() or not n1[:size].sum():
        return None
    base = float(n1[:size].sum(dtype=np.float64) / (n0[:size].sum(dtype=np.float64)
                                                    + n1[:size].sum(dtype=np.float64)))
    stem = (n1[size:] + STEM_PRIOR * base) / (n0[size:] + n1[size:] + STEM_PRIOR)
    m = Model(n1[:size].copy(), (n0 + n1)[:size], stem.astype(np.float32), base)
    held = cut(_scan(rows.where("fold = 3").select(F.col("_y").cast("long").alias("doc_id"),
                                                   F.col("_text").alias("text")), m), "tox-held")
    q = held.where("doc_id = 0 and best > 0").agg(F.percentile_approx(
        F.col("best") - F.log("n_tokens"), [0.5, 0.9], 10_000).alias("q")).first()["q"]
    if q and q[1] > q[0]:
        # of a Gumbel law: the distance between the median and the 0.9 quantile
        m.rate = float((2.2503673 - 0.3665129) / (q[1] - q[0]))
        m.place = float(m.rate * q[0] - 0.3665129)
    bins = _scan(rows.where("fold = 3").select(F.col("_y").cast("long").alias("doc_id"),
                                               F.col("_text").alias("text")), m) \
        .groupBy(F.round(F.col("evidence") / BIN).cast("int").alias("x"), "doc_id").count().toArrow()
    _calibrate(m, bins["x"].to_numpy() * BIN, bins["doc_id"].to_numpy(), bins["count"].to_numpy())
    return m


def _calibrate(m: Model, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
    """Logistic curve through the binned evidence: Newton steps, with Platt's
    smoothed targets and a small ridge."""
    n1, n0 = n[y == 1].sum(), n[y == 0].sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.clip(x, *CURVE)
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, w = n * (p - t), n * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        d = np.linalg.solve(h, [(g * x).sum() + 1e-3 * a, g.sum()])
        a, b = max(a - d[0], 1e-3), b - d[1]
        if abs(d).max() < 1e-8:
            break
    m.slope, m.shift = float(a), float(b)


def _scan(rows: DataFrame, m: Model) -> DataFrame:
    """(doc_id, n_tokens, n_passages, best, evidence) of (doc_id, text); a
    text_hash in third place is handed on."""
    extra = rows.columns[2:]
    sent = rows.sparkSession.sparkContext.broadcast(vars(m))     # 12 MB, whatever the input

    def run(batches):
        model = Model(**sent.value)
        for b in batches:
            w = Words(b.column(1).to_pylist(), head=STEM_BYTES)
            s = token_scores(model, w)
            best, n_pass, ev = [], [], []
            for lo, hi in zip(w.starts.tolist(), w.ends.tolist()):
                seg = segments(s[lo:hi])
                n_pass.append(sum(surprise(model, v, hi - lo) > 0 for _, _, v in seg))
                best.append(max((v for _, _, v in seg), default=0.0))
                ev.append(evidence(model, seg, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(w.counts), pa.array(n_pass, pa.int64()),
                 pa.array(best, pa.float64()), pa.array(ev, pa.float64()), *b.columns[2:]],
                names=["doc_id", "n_tokens", "n_passages", "best", "evidence", *extra])
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_passages long, best double, "
                                "evidence double" + "".join(f", {c} long" for c in extra))


def passages(docs: DataFrame, m: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, first_word, n_words, score, text) of every significant passage
    (expected number in a clean text below 1)."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vars(m))

    def run(batches):
        model = Model(**sent.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            w = Words(texts, head=STEM_BYTES)
            s = token_scores(model, w)
            out = []
            for i, (lo, hi) in enumerate(zip(w.starts.tolist(), w.ends.tolist())):
                for a, e, v in segments(s[lo:hi]):
                    if surprise(model, v, hi - lo) > 0:
                        out.append((b.column(0)[i].as_py(), a, e - a, v,
                                    b" ".join(w.strings(np.arange(lo + a, lo + e))).decode("utf-8", "replace")))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(),
                                                             pa.float64(), pa.string()))],
                names=["doc_id", "first_word", "n_words", "score", "text"])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, first_word long, n_words long, score double, text string")


def _score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``score`` and text_hash, which tells the texts of one
    doc_id apart."""
    m = fit(docs, labels, id_col, text_col, max_labelled)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    if m is None:
        return rows.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                           F.lit(0).cast("long").alias("n_passages"), F.lit(FLOOR).alias("evidence"),
                           "text_hash")
    x = F.least(F.greatest(F.col("evidence"), F.lit(CURVE[0])), F.lit(CURVE[1]))
    z = F.lit(m.slope) * x + F.lit(m.shift)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
    out = _scan(rows, m).withColumn("score", p)
    return out.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int")
                      .alias("predicted"), "n_passages", "evidence", "text_hash")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages, evidence) per row."""
    return _score(docs, labels, id_col, text_col, max_labelled, threshold).drop("text_hash")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **kw) -> DataFrame:
    """Rows of ``docs`` but those of a doc_id and text predicted toxic."""
    bad = _score(docs, labels, id_col, text_col, **kw).where("predicted = 1 and doc_id is not null") \
        .select(F.col("doc_id").alias("_bad"), F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(bad.hint("merge"), (F.col(id_col).cast("long") == F.col("_bad"))
                     & (F.xxhash64(text_col) == F.col("_bad_text")), "left_anti")
