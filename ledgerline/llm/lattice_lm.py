"""Document probability under a subword lattice that backs off word counts.

The pieces are an existing subword vocabulary with its scores; no tokenizer is
trained. Every segmentation of a word into pieces counts: its lattice
probability L(w) is the sum over all of them, by a forward recursion in log
space. A word begins with a piece that holds the word mark and goes on with
pieces that do not, so the sums over all words are one, and the lattice of a
text is the chain of its words' lattices; each distinct word's sum is taken
once for the corpus.

The corpus gives one table of distinct words with training counts c, N in all
of V distinct words. A word's probability is the mixture

    P(w) = (c + V * L(w)) / (N + V),

so that what was seen counts as often as it was seen, what was not is spelled
by the lattice with the share of mass that the number of distinct words calls
for, and all words together have probability one. A text is its words, each
after a decision to go on, and a decision to end.

The vocabulary at hand is a BPE model: its scores are merge ranks, read as Zipf
weights in place of unigram scores; byte pieces, which have no rank, get the
lowest weight of all. Piece weights start from these and are re-estimated on
the training documents' word counts by expectation-maximisation; the
vocabulary's weights stay as the prior.

The most frequent words of all texts, at most ``HEAD`` whatever the input (a
histogram of counts finds the cut), are broadcast as a fixed-size table; all
others are joined with a shuffle, so every word is looked up. Words are told
apart by 64-bit hashes in the lookups and by their text in the counts.

Defined cases: a null, empty or blank text is the end mark alone; rows with a
null doc_id train nothing and are held out; repeated rows count and score each;
very long texts are counted and scored whole, piece by piece; without training
words every word is spelled; an empty table gives an empty result; other
columns are unused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, as_int64, cut, small_batches

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"              # begins a word's first piece
HEAD = 1 << 18               # words in the broadcast table
SLOT_BITS = 21
BUFFER = 300_000             # distinct words a counting task holds before it emits
PRIOR = 5_000.0              # pseudo-pieces drawn from the vocabulary's own weights
ROUNDS = 1
NEG = float("-inf")


def _is_byte(piece: str) -> bool:
    return len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")


def load_vocabulary(path: str) -> dict[str, float]:
    """Piece -> log weight from the vocabulary's scores. Byte pieces keep
    their names <0xHH> and weigh as the lowest other piece does; pieces that hold a word mark elsewhere than in front
    span words and are left out, as are control pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    kept = [(p, s) for p, s in kept if MARK not in p[1:]]
    # bytes have no rank (score 0), the bare mark has -1e9: both come last
    weights = {p: 1.0 / (2.7 + (len(kept) if _is_byte(p) else min(max(0.0, -s), len(kept))))
               for p, s in kept}
    total = sum(weights.values())
    return {p: math.log(w / total) for p, w in weights.items()}


class Lattice:
    """All segmentations of a word. ``pieces``: piece -> log probability."""

    def __init__(self, pieces: dict[str, float]):
        self.table: dict[str, float | None] = {}
        for p in pieces:
            if not _is_byte(p):
                for k in range(1, len(p)):
                    self.table.setdefault(p[:k], None)
                self.table[p] = pieces[p]
        for p, v in pieces.items():
            if p in self.table:
                self.table[p] = v
        floor = min(pieces.values(), default=0.0)
        self.bytes = [pieces.get(f"<0x{b:02X}>", floor) for b in range(256)]

    def spelled(self, c: str) -> float:
        return sum(self.bytes[b] for b in c.encode("utf-8", "surrogatepass"))

    def forward(self, word: str, edges: list | None = None) -> list[float]:
        """alpha[i]: log probability of the first i characters. ``edges``
        collects (start, end, piece or None for bytes, log probability)."""
        text = MARK + word
        n, table, exp, log1p = len(text), self.table, math.exp, math.log1p
        alpha = [NEG] * (n + 1)
        alpha[0] = 0.0
        for i in range(n):
            a = alpha[i]
            if a == NEG:
                continue
            end = i + 1
            single = False
            while end <= n:
                piece = text[i:end]
                if piece not in table:
                    break
                lp = table[piece]
                if lp is not None and not (i and text[i] == MARK):
                    single = single or end == i + 1
                    x, y = a + lp, alpha[end]
                    if y == NEG:
                        alpha[end] = x
                    elif x > y:
                        alpha[end] = x + log1p(exp(y - x))
                    else:
                        alpha[end] = y + log1p(exp(x - y))
                    if edges is not None:
                        edges.append((i, end, piece, lp))
                end += 1
            if not single:       # a character without a piece is spelled in bytes
                lp = self.spelled(text[i])
                x, y = a + lp, alpha[i + 1]
                alpha[i + 1] = max(x, y) + (log1p(exp(-abs(x - y))) if y != NEG else 0.0)
                if edges is not None:
                    edges.append((i, i + 1, None, lp))
        return alpha

    def log_prob(self, word: str) -> float:
        return self.forward(word)[-1]

    def expect(self, word: str, weight: float, into: dict[str, float]) -> None:
        """Add the expected piece counts of ``weight`` occurrences."""
        edges: list = []
        alpha = self.forward(word, edges)
        n, exp, log1p = len(alpha) - 1, math.exp, math.log1p
        beta = [NEG] * (n + 1)
        beta[n] = 0.0
        for i, end, piece, lp in reversed(edges):
            b = beta[end]
            if b == NEG:
                continue
            x, y = b + lp, beta[i]
            if y == NEG:
                beta[i] = x
            elif x > y:
                beta[i] = x + log1p(exp(y - x))
            else:
                beta[i] = y + log1p(exp(x - y))
        z = alpha[n]
        text = MARK + word
        for i, end, piece, lp in edges:
            g = alpha[i] + lp + beta[end] - z
            if g > -30.0:
                g = weight * exp(g)
                if piece is not None:
                    into[piece] = into.get(piece, 0.0) + g
                else:
                    for c in text[i].encode("utf-8", "surrogatepass"):
                        k = f"<0x{c:02X}>"
                        into[k] = into.get(k, 0.0) + g


def _held(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c, n) over all documents; c counts training occurrences only, n
    all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: dict[bytes, int] = {}
        trained: dict[bytes, int] = {}

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(every), pa.binary()).cast(pa.string()),
                 pa.array([trained.get(w, 0) for w in every], pa.int64()),
                 pa.array(list(every.values()), pa.int64())], names=["word", "c", "n"])
            every.clear()
            trained.clear()
            return out
        for b in batches:
            w = Words(b.column(1).to_pylist())
            train = np.repeat(~np.array(b.column(0).to_pylist(), bool), w.counts)
            _, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
            n = np.bincount(inverse, minlength=len(first))
            c = np.bincount(inverse, weights=train, minlength=len(first)).astype(np.int64)
            by = np.argsort(first)
            for word, k, m in zip(w.strings(first[by]), c[by].tolist(), n[by].tolist()):
                every[word] = every.get(word, 0) + m
                if k:
                    trained[word] = trained.get(word, 0) + k
            if len(every) > BUFFER:
                yield flush()
        yield flush()
    return rows.select("held_out", "text").mapInArrow(run, "word string, c long, n long") \
        .groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def fit_pieces(words: DataFrame, vocabulary: dict[str, float], rounds: int = ROUNDS) -> dict[str, float]:
    """Re-estimate the piece weights; the driver holds one row per piece."""
    spark = words.sparkSession
    prior, now = vocabulary, vocabulary
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(now)

        def run(batches):
            lattice, into = Lattice(sent.value), {}
            for b in batches:
                for word, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    lattice.expect(word, c, into)
            yield pa.RecordBatch.from_arrays([pa.array(list(into), pa.string()),
                                              pa.array(list(into.values()), pa.float64())],
                                             names=["piece", "n"])
        got = words.where("c > 0").select("word", "c").mapInArrow(run, "piece string, n double") \
            .groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        n = dict(zip(got["piece"].to_pylist(), got["n"].to_pylist()))
        total = sum(n.values()) + PRIOR
        now = {p: math.log((n.get(p, 0.0) + PRIOR * math.exp(v)) / total) for p, v in prior.items()}
    return now


def _head_cut(words: DataFrame, limit: int) -> int:
    """Smallest number of occurrences such that at most ``limit`` words have it
    or more; the histogram has at most 1,024 bins."""
    bins = words.groupBy(F.floor(F.log2("n") * 16).alias("b")) \
        .agg(F.count("*").alias("n"), F.min("n").alias("lo")).orderBy(F.desc("b")).collect()
    total, at = 0, 1 << 62
    for r in bins:
        total += r["n"]
        if total > limit:
            break
        at = r["lo"]
    return at


def mixed(c: np.ndarray, lp: np.ndarray, total: float, distinct: float) -> np.ndarray:
    """log10 of (c + distinct * 10**lp) / (total + distinct)."""
    with np.errstate(divide="ignore", under="ignore"):
        seen = np.log10(c + distinct * np.power(10.0, lp))
    return np.where(c > 0, seen, math.log10(distinct) + lp) - math.log10(total + distinct)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str | None = None, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    per row; ``vocabulary`` is the path of a sentencepiece model."""
    spark = docs.sparkSession
    small_batches(spark)
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    pieces0 = load_vocabulary(vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       _held(F.col(id_col).cast("long")).alias("held_out"))
    words = cut(word_counts(rows), "lm-words")
    pieces = fit_pieces(words, pieces0, rounds)
    seen = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    total, distinct = float(seen["n"] or 0), float(max(seen["v"], 1))

    sent = spark.sparkContext.broadcast(pieces)

    def weigh(batches):
        lattice = Lattice(sent.value)
        ln10 = math.log(10)
        for b in batches:
            texts = b.column(0).to_pylist()
            lp = np.array([lattice.log_prob(t) / ln10 for t in texts], np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_int64(Words(texts).hashes)), b.column(1), b.column(2),
                 pa.array(mixed(b.column(1).to_numpy(), lp, total, distinct))],
                names=["h", "c", "n", "lp"])
    # one word a text, so one hash a row
    scored = cut(words.mapInArrow(weigh, "h long, c long, n long, lp double"), "lm-weighed")
    at = _head_cut(scored, head)
    top = scored.where(F.col("n") >= at).toArrow()        # at most ``head`` rows
    h = top["h"].to_numpy().view(np.uint64)
    c, lp = top["c"].to_numpy(), top["lp"].to_numpy()
    slot = np.full(1 << SLOT_BITS, -1, np.int32)
    by = np.argsort(top["n"].to_numpy(), kind="stable")    # of a shared slot, the more frequent word
    slot[(h[by] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)] = by
    table = spark.sparkContext.broadcast((slot, h, c > 0, np.log10(c + 1.0), lp))

    def first(batches):
        slot, h, seen_, lc, lp = table.value
        none = len(h) == 0
        for b in batches:
            w = Words(b.column(2).to_pylist())
            i = slot[(w.hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
            hit = np.zeros(len(i), bool) if none else (i >= 0) & (h[i] == w.hashes)
            j, doc = i[hit], np.repeat(np.arange(b.num_rows), w.counts)
            rest = np.bincount(doc[~hit], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(w.counts),
                 pa.array(np.bincount(doc[hit], seen_[j], b.num_rows).astype(np.int64)),
                 pa.array(np.bincount(doc[hit], lc[j], b.num_rows).astype(np.float64)),
                 pa.array(np.bincount(doc[hit], lp[j], b.num_rows).astype(np.float64)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rest)]), pa.int32()),
                                          pa.array(as_int64(w.hashes[~hit])))],
                names=["doc_id", "held_out", "n", "known", "base", "lm", "rest"])
    part = cut(rows.select("doc_id", "held_out", "text").mapInArrow(
        first, "doc_id long, held_out boolean, n long, known long, base double, lm double, "
               "rest array<long>").withColumn("uid", F.monotonically_increasing_id()), "lm-docs")
    tail = part.select("uid", F.explode("rest").alias("h")).join(scored.hint("merge"), "h") \
        .groupBy("uid").agg(F.count(F.when(F.col("c") > 0, 1)).alias("t_known"),
                            F.sum(F.log10(F.col("c") + 1.0)).alias("t_base"), F.sum("lp").alias("t_lm"))
    train_docs = part.where("not held_out").count()
    n_train = (seen["n"] or 0) + train_docs
    v = seen["v"] + (train_docs > 0)
    denominator = math.log10(n_train + v + 1)
    # before each word, and at the end: go on, or end
    ends, runs = train_docs + 1.0, (seen["n"] or 0) + 1.0
    end_lp, go_lp = math.log10(ends / (ends + runs)), math.log10(runs / (ends + runs))
    zero = F.lit(0.0)
    return part.drop("rest").join(tail.hint("merge"), "uid", "left").select(
        "doc_id", "held_out", (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("t_known", F.lit(0)) + int(train_docs > 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("t_base", zero) + F.lit(math.log10(train_docs + 1.0))
         - (F.col("n") + 1) * F.lit(denominator)).alias("base_score"),
        (F.col("lm") + F.coalesce("t_lm", zero) + F.col("n") * F.lit(go_lp) + F.lit(end_lp))
        .alias("score"))
