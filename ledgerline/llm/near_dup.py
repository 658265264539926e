"""Near-duplicate documents by one-permutation MinHash.

A document is its set of distinct word shingles. One hash pass splits the
hash range into bins and keeps each bin's smallest value; empty bins take the
value of a non-empty bin chosen by a bin-specific random probe sequence
(optimal densification). Bins are banded, documents that agree on a band
share a bucket, and each bucket proposes a star: its smallest member against
all others, so candidate pairs stay linear in the bucket. Candidates are
confirmed on the full shingle sets.

Documents of equal sets are one vertex from the start, so groups of exact
copies, however large, cost one aggregate. Stars alone would lose a link
between two members that are both unlike the centre; for buckets whose
members are not yet connected, the pairs across components are confirmed too.
There the Jaccard distance to the centre, known exactly, is a metric bound:
|d(c,x) - d(c,y)| > 1 - threshold proves that x and y are no link. Pairs of
larger sets must also agree in a second sketch, two bits from each of all
bins, up to 5.5 standard deviations (of independent bins) from what a link at
the threshold gives. The bins of a small set copy few values and spread more:
simulated, the limit is 4.9 of their deviations off for unions of 76 to 80
shingles, 5.0 for 160, 5.6 for 1,000; by the normal tail this loses 1 link at
the threshold in a million or fewer, the bands about 5. ``sketch=False`` leaves
the second sketch out: then every pair that shares a band is confirmed.
A pair is proposed only by the first band that it shares.

Defined cases: null or blank texts have no shingle, are their own component
and are kept; rows that share a doc_id are one vertex; a null doc_id cannot
name a component: such rows are linked with nothing, component_id is null and
they are kept; an empty table gives an empty result; other columns are unused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, as_int64, cut, hot_join, mix64, prefix_sums, small_batches
from .graph import components

SHINGLE = 5
BINS = 1024
BANDS = 32
ROWS = 4                     # bins per band; the bands use the first BANDS * ROWS bins
SKETCHED = 64                # sets of at least so many shingles are held to the sketch
DEVIATIONS = 5.5             # of the sketch, from its mean for a link at the threshold
MATCH = (75, 100)            # intersection : union, at least
PROBES = 512
WIDE = 256                   # members of an open bucket that meet pair by pair, at most

_U = np.uint64


def shingle_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    w = Words(texts)
    h, n = w.hashes, len(w.hashes)
    coef = mix64(np.arange(1, k + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
    out = []
    with np.errstate(over="ignore"):
        roll = np.zeros(max(n - k + 1, 0), np.uint64)
        for j in range(k):
            roll += h[j:j + len(roll)] * coef[j]
        roll = mix64(roll)
        for s, e in zip(w.starts.tolist(), w.ends.tolist()):
            if e - s >= k:
                out.append(np.unique(roll[s:e - k + 1]))
            elif e > s:      # fewer words: the whole sequence as one shingle
                out.append(mix64((h[s:e] * coef[:e - s]).sum(keepdims=True, dtype=np.uint64)
                                 + _U((e - s) * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)))
            else:
                out.append(h[:0])
    return out


def _probe_table(bins: int, probes: int) -> np.ndarray:
    j = np.arange(bins * probes, dtype=np.uint64)
    return (mix64(j + _U(0x5851F42D4C957F2D)) % _U(bins)).astype(np.int64).reshape(bins, probes)


def one_permutation(values: np.ndarray, bins: int, probe: np.ndarray) -> np.ndarray:
    """Signature of a sorted, non-empty array of distinct hashes."""
    shift = _U(64 - (bins.bit_length() - 1))
    at, first = np.unique(values >> shift, return_index=True)
    sig = np.zeros(bins, np.uint64)
    full = np.zeros(bins, bool)
    at = at.astype(np.int64)
    sig[at], full[at] = values[first], True
    empty = np.flatnonzero(~full)
    source = sig.copy()
    t = 0
    while len(empty):
        # the table's probes first, then the bins in turn: always ends
        cand = probe[empty, t] if t < probe.shape[1] else (empty + t) % bins
        ok = full[cand]
        sig[empty[ok]] = source[cand[ok]]
        empty, t = empty[~ok], t + 1
    return sig


def sketch_limit(bins: int, match: tuple[int, int]) -> float:
    """Bits in which the sketches of a link may differ: what a link at the
    threshold gives on average, and DEVIATIONS deviations."""
    least = match[0] / match[1]
    spread = (least * (1 - least) / 4 + (1 - least) / 8) / bins
    return 2 * bins * ((1 - least) / 2 + DEVIATIONS * spread ** 0.5)


def features(docs: DataFrame, id_col: str, text_col: str, bins: int, bands_: int, rows: int,
             k: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, bits): set_a and set_b, with
    n_shingles, identify the set (128 bits of order-free sums); bits holds
    two bits of each bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = _probe_table(bins, PROBES)
        used = bands_ * rows
        coef = mix64(np.arange(1, used + 1, dtype=np.uint64)) | _U(1)
        salt = mix64(np.arange(1, bands_ + 1, dtype=np.uint64) + _U(77))
        place = mix64(np.arange(bins, dtype=np.uint64) + _U(991))     # bits differ from bin to bin
        for b in batches:
            sets = shingle_sets(b.column(1).to_pylist(), k)
            bands, a, c, bits = [], [], [], []
            with np.errstate(over="ignore"):
                for s in sets:
                    a.append(s.sum(dtype=np.uint64))
                    c.append(mix64(s).sum(dtype=np.uint64))
                    if len(s):
                        sig = one_permutation(s, bins, probe)
                        part = (sig[:used] * coef).reshape(-1, rows)
                        bands.append(mix64(part.sum(1, dtype=np.uint64) ^ salt))
                        two = (mix64(sig ^ place) >> _U(62)).astype(np.uint8)
                        bits.append(np.packbits(np.stack([two & 1, two >> 1], 1).ravel()).view(np.int64))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
            flat_bits = np.concatenate(bits) if bits else np.zeros(0, np.int64)
            full = np.array([bool(len(s)) for s in sets], np.int64)
            at = lambda n: pa.array(np.concatenate([[0], np.cumsum(full * n)]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(as_int64(np.array(a, np.uint64))),
                pa.array(as_int64(np.array(c, np.uint64))),
                pa.ListArray.from_arrays(at(bands_), pa.array(as_int64(flat))),
                pa.ListArray.from_arrays(at(bins // 32), pa.array(flat_bits))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
             "bits array<long>")


def _with_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``."""
    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1).to_pylist(), k)
            ends = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                       pa.array(as_int64(flat)))],
                names=["doc_id", "shingles"])
    # one row per vertex: class representatives are unique but for repeated ids
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(
        run, "doc_id long, shingles array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, match: tuple[int, int]) -> DataFrame:
    """pairs (u, v) -> (u, v, common, total, linked), on the full sets."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("_b"))
    both = (pairs.join(a.hint("merge"), "u").join(b.hint("merge"), "v")
            .select("u", "v", F.size("_a").cast("long").alias("_na"),
                    F.size("_b").cast("long").alias("_nb"),
                    F.size(F.array_intersect("_a", "_b")).cast("long").alias("common")))
    out = both.select("u", "v", "common", (F.col("_na") + F.col("_nb") - F.col("common"))
                      .alias("total"))
    return out.withColumn("linked", F.col("common") * match[1] >= F.col("total") * match[0])


def _groups_apart(rows: DataFrame, on: str) -> DataFrame:
    """(on, n, top) of the groups with more than one label: their number of
    rows and most frequent label."""
    return rows.groupBy(on, "label").agg(F.count("*").alias("_n")).groupBy(on).agg(
        F.sum("_n").alias("n"), F.max_by("label", F.struct("_n", "label")).alias("top"),
        F.count("*").alias("_labels")).where("_labels > 1").drop("_labels")


def _pairs_apart(rows: DataFrame, on: str, match: tuple[int, int], keep: Column) -> DataFrame:
    """Distinct pairs (u, v) of rows (on, rep, n_shingles, label, top, ...) of one
    group and different labels, of sizes that can reach the threshold; ``keep``
    is a further condition on x and y. Rows of the group's top label are met by
    the others only."""
    x, y = rows.where("label <> top").alias("x"), rows.alias("y")
    return (x.join(y.hint("merge"), on)
            .where((F.col("x.label") != F.col("y.label"))
                   & ((F.col("y.label") == F.col("y.top")) | (F.col("x.rep") < F.col("y.rep")))
                   & (F.least("x.n_shingles", "y.n_shingles") * match[1]
                      >= F.greatest("x.n_shingles", "y.n_shingles") * match[0]) & keep)
            .select(F.least("x.rep", "y.rep").alias("u"), F.greatest("x.rep", "y.rep").alias("v")).distinct())


def rare_shingles(sets: DataFrame, match: tuple[int, int]) -> DataFrame:
    """(shingle, rep, size, at): of each set's first n - ceil(t n) + 1 shingles,
    the rarest in these sets first, those that another set holds too, and their
    place in that order, from 1."""
    each = sets.select(F.col("doc_id").alias("rep"), F.size("shingles").alias("size"),
                       F.xxhash64("shingles").alias("_set"), F.explode("shingles").alias("shingle"))
    held = cut(each.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1"), "nd-held")
    both = hot_join(each, held, ["shingle"], "held", F.pmod(F.xxhash64("rep"), F.lit(64))) \
        .where("held is not null")
    # a set's shingles that no other holds come first in the order
    own = both.groupBy("rep", "_set", "size").agg(
        F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("_by")) \
        .withColumn("_single", F.col("size") - F.size("_by"))
    first = F.expr(f"cast(size - (({match[0]}L * size + {match[1] - 1}) div {match[1]}) + 1 as int)")
    left = F.greatest(first - F.col("_single"), F.lit(0))
    return own.select("rep", "size", "_single", F.posexplode(F.slice("_by", F.lit(1), left)).alias("_i", "_s")) \
        .select(F.col("_s.shingle").alias("shingle"), "rep", "size",
                (F.col("_single") + F.col("_i") + 1).alias("at")).distinct()


def _can_reach(match: tuple[int, int]) -> Column:
    """Whether sets x and y can reach the threshold if the shingle at hand is the
    first in the order that they share: true of that one for every link."""
    most = 1 + F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at")).cast("long")
    return most * (match[0] + match[1]) >= (F.col("x.size") + F.col("y.size")).cast("long") * match[0]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, bins: int = BINS, bands: int = BANDS, rows: int = ROWS,
                    match: tuple[int, int] = MATCH, sketch: bool = True, wide: int = WIDE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    small_batches(docs.sparkSession)
    f = cut(features(docs, id_col, text_col, bins, bands, rows, shingle), "nd-features")
    key = ["set_a", "set_b", "n_shingles"]
    has = f.where("n_shingles > 0 and doc_id is not null")
    classes = has.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    # bands of the classes' representatives only
    reps = has.join(classes.withColumnRenamed("rep", "doc_id").drop("copies").hint("merge"), [*key, "doc_id"],
                    "left_semi")
    rows_ = reps.select(F.col("doc_id").alias("rep"), "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = cut(rows_.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("_last"),
                                          F.count("*").alias("n"))
                 .where("centre <> _last").drop("_last"), "nd-shared")
    spread = F.pmod(F.xxhash64("rep"), F.lit(64))
    members = cut(hot_join(rows_, shared, ["key"], "n", spread).where("centre is not null").drop("n"),
                  "nd-buckets")
    stars = members.where("rep <> centre").select(F.col("centre").alias("u"), F.col("rep").alias("v"))
    stars = stars.distinct()
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = cut(_with_sets(docs, ids, id_col, text_col, shingle), "nd-sets")
    first = cut(_confirm(stars, sets, match).groupBy("u", "v").agg(
        F.max("linked").alias("linked"), F.max(F.col("common") / F.col("total")).alias("near")),
        "nd-stars")
    label = components(first.where("linked").select("u", "v"))

    # buckets whose members are still apart: pairs across components
    near = first.select(F.col("u").alias("centre"), F.col("v").alias("rep"),
                        (1.0 - F.col("near")).alias("far"))
    named = (members.join(near.hint("merge"), ["centre", "rep"], "left")
             .join(label.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
             .withColumn("label", F.coalesce("label", "rep"))
             .select("key", "band", "rep", "n_shingles", "label", F.coalesce("far", F.lit(0.0)).alias("far"),
                     (F.col("rep") == F.col("centre")).alias("is_centre")))
    named = cut(named, "nd-open")
    apart = named.where("not is_centre").drop("is_centre")
    open_ = cut(_groups_apart(apart, "key"), "nd-apart")
    rest = hot_join(apart, open_, ["key"], "n", spread).where("top is not null")
    words = bins // 32 if sketch else 0
    bits = reps.select(F.col("doc_id").alias("rep"), "bands",
                       *[F.col("bits")[i].alias(f"b{i}") for i in range(words)])
    alike = F.lit(True)
    if sketch:
        off = sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(words)), F.lit(0))
        alike = (F.least("x.n_shingles", "y.n_shingles") < SKETCHED) | (off <= sketch_limit(bins, match))
    seen = F.arrays_overlap(F.slice("x.bands", F.lit(1), F.col("x.band")),
                            F.slice("y.bands", F.lit(1), F.col("x.band")))
    slack = 1.0 - match[0] / match[1] + 1e-9
    across = _pairs_apart(rest.where(F.col("n") <= wide).join(bits.hint("merge"), "rep"), "key", match,
                          (F.abs(F.col("x.far") - F.col("y.far")) <= slack) & alike & ~seen)
    if open_.where(F.col("n") > wide).limit(1).count():
        # members of wide buckets: pairs that share a rare shingle and any band
        far = cut(rest.where(F.col("n") > wide).select("rep", "n_shingles", "label").distinct(), "nd-wide")
        rare = rare_shingles(sets.join(far.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id",
                                       "left_semi"), match)
        rare = cut(rare.join(far.hint("merge"), "rep"), "nd-rare")
        met = hot_join(rare, cut(_groups_apart(rare, "shingle"), "nd-rare-apart"), ["shingle"], "n", spread)
        met = _pairs_apart(met.where("top is not null"), "shingle", match, _can_reach(match))
        full = far.select("rep", "n_shingles").join(bits.hint("merge"), "rep")
        x, y = full.alias("x"), full.alias("y")
        across = across.unionByName(
            met.join(x.hint("merge"), F.col("u") == F.col("x.rep"))
            .join(y.hint("merge"), F.col("v") == F.col("y.rep"))
            .where(alike & F.arrays_overlap("x.bands", "y.bands")).select("u", "v")).distinct()
    across = across.join(first.select("u", "v").hint("merge"), ["u", "v"], "left_anti")
    second = _confirm(across, sets, match).where("linked").select("u", "v")
    label = components(first.where("linked").select("u", "v").unionByName(second))

    moved = label.where("node <> label")
    named_class = cut(classes.join(moved.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
                      .select(*key, "copies", F.coalesce("label", "rep").alias("component_id")), "nd-classes")
    linked = hot_join(has.drop("bands", "bits"), named_class, key, "copies",
                      F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    rest = f.where("n_shingles = 0 or doc_id is null").drop("bands", "bits") \
        .withColumn("component_id", F.col("doc_id"))
    return linked.select(*rest.columns).unionByName(rest).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **kw) -> DataFrame:
    """Rows of ``docs`` whose document is its component's kept one. A document
    is a doc_id and a text: rows that share a doc_id but not the text are
    decided each by its own, of rows that share both the one with the smallest
    row hash stays (rows with a null doc_id all stay)."""
    key = ["_id", "_none", "_hash"]
    rows = docs.where(F.col(id_col).isNotNull()).withColumns({
        "_id": F.col(id_col).cast("long"), "_none": F.col(text_col).isNull(), "_hash": F.xxhash64(text_col)})
    each = rows.select(*key).distinct()
    if each.groupBy("_id").count().where("count > 1").limit(1).count():
        # numbers of the documents in order of doc_id take the place of the ids
        at = prefix_sums(each.withColumn("_one", F.lit(1)), key, {"_vertex": "_one"}, "nd-rows")
        rows = cut(rows.join(at.drop("_one").hint("merge"), key), "nd-named")
    else:
        rows = rows.withColumn("_vertex", F.col("_id"))
    kept = near_duplicates(rows, id_col="_vertex", text_col=text_col, **kw).where("kept") \
        .select(F.col("doc_id").alias("_kept")).distinct()
    named = rows.join(kept.hint("merge"), F.col("_vertex") == F.col("_kept"), "left_semi")
    one = Window.partitionBy("_vertex").orderBy(F.xxhash64(*docs.columns))
    return named.withColumn("_one", F.row_number().over(one)).where("_one = 1").select(*docs.columns).unionByName(
        docs.where(F.col(id_col).isNull()))
