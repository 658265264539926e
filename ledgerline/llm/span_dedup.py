"""Repeated passages by sliding sentence spans.

A text is cut into sentences (at . ! ? followed by white space, and at line
ends). From every sentence on, and back from every sentence, the shortest run
of several consecutive sentences with enough words is a span, and so is every
single sentence with enough words, so that a text without sentence ends and a
long sentence among other neighbours are found as well; spans are hashed and
joined over the corpus. Of a span that occurs more than once, the first
occurrence (by doc_id, then place) stays, and the sentences that any other
occurrence covers are removed. Runs taken forwards and backwards let the spans
of a repeated passage cover it to its very last sentence.

Spans of one hash are pre-aggregated to their first occurrence and count
before the shuffle; hashes that repeat are joined back, those with very many
occurrences by a broadcast (their counts are known, see ``hot_join``), so that
no task gets all occurrences of one.

Defined cases: null and blank texts have no sentence and come back as they
are; a text shorter than a span loses nothing; rows that share a doc_id are
told apart by a hash of the text, and rows repeated whole are one document
(they come back alike, none loses text to the other); a null doc_id comes
last; an empty table gives an empty result; other columns are unused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, as_int64, cut, hot_join, mix64, small_batches

SENTENCES = 2                # a span of several sentences has at least so many
WORDS = 20                   # and so many words; a single sentence of so many is a span too
_END = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+|[\n\r]+[\x20\x09-\x0D]*")


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences, the white space after them included, so
    that they tile the text."""
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    return list(zip([0, *ends[:-1]], ends)) if text else []


def runs(n_words: np.ndarray, sentences: int, words: int) -> list[tuple[int, int]]:
    """Distinct shortest runs [i, j) with both least counts, from every
    sentence on and back from every sentence, and the single sentences with
    enough words, in order."""
    n = len(n_words)
    total = np.concatenate([[0], np.cumsum(n_words)])
    i = np.arange(n)
    on = np.maximum(np.searchsorted(total, total[i] + words, "left"), i + sentences)
    back = np.minimum(np.searchsorted(total, total[i + 1] - words, "right") - 1, i + 1 - sentences)
    out = {(a, b) for a, b in zip(i.tolist(), on.tolist()) if b <= n}
    out |= {(a, b) for a, b in zip(back.tolist(), (i + 1).tolist()) if a >= 0}
    out |= {(a, a + 1) for a in np.flatnonzero(n_words >= words).tolist()}
    return sorted(out)


def _sentence_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Words and hash of each sentence; case and white space don't count."""
    at = sentence_bounds(text)
    w = Words([text[s:e] for s, e in at])
    order = np.arange(len(w.hashes)) - np.repeat(w.starts, w.counts)
    with np.errstate(over="ignore"):
        part = w.hashes * (mix64(order.astype(np.uint64) + np.uint64(1)) | np.uint64(1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
        return w.counts, mix64(total[w.ends] - total[w.starts] + w.counts.astype(np.uint64))


def spans(rows: DataFrame, sentences: int, words: int) -> DataFrame:
    """(doc_id, uid, first, n, hash) per span of (doc_id, uid, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, first, count, hashes = [], [], [], []
            for k, text in enumerate(b.column(2).to_pylist()):
                if not text:
                    continue
                n, h = _sentence_hashes(text)
                full = np.flatnonzero(n)                   # blank sentences don't count
                found = runs(n[full], sentences, words)
                if not found:
                    continue
                a, e = np.array(found).T
                with np.errstate(over="ignore"):
                    # hash of a run: its sentences, weighted by their place in it
                    acc, longest = np.zeros(len(a), np.uint64), int((e - a).max())
                    for j in range(longest):
                        on = a + j < e
                        acc[on] = mix64(acc[on] * np.uint64(0x9E3779B97F4A7C15)
                                        + h[full[a[on] + j]] + np.uint64(1))
                who.append(np.full(len(a), k))
                first.append(full[a])
                count.append(full[e - 1] - full[a] + 1)
                hashes.append(acc)
            if who:
                at = np.concatenate(who)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                     pa.array(np.concatenate(first).astype(np.int32)),
                     pa.array(np.concatenate(count).astype(np.int32)),
                     pa.array(as_int64(np.concatenate(hashes)))],
                    names=["doc_id", "uid", "first", "n", "hash"])
    return rows.select("doc_id", "uid", "text").mapInArrow(
        run, "doc_id long, uid long, first int, n int, hash long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sentences: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """(doc_id, n_sentences, n_removed, words_removed, first_doc_ids, removed,
    text), one row per row of ``docs``: ``text`` without the repeated
    sentences, ``removed`` the spans taken out as (start, end) in code points,
    ``first_doc_ids`` the documents that keep them."""
    small_batches(docs.sparkSession)
    # the row id hashes the text, so that it holds for every reading of the input
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .withColumn("uid", F.xxhash64("doc_id", "text"))
    s = cut(spans(rows, sentences, words), "sd-spans")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "first")
    groups = cut(s.groupBy("hash").agg(F.min(place).alias("main"), F.count("*").alias("k")).where("k > 1"),
                 "sd-repeats")
    others = hot_join(s, groups, ["hash"], "k", F.xxhash64("uid", "first")) \
        .where(F.col("main").isNotNull() & (place != F.col("main"))) \
        .select("doc_id", "uid", "first", "n", F.col("main.doc_id").alias("keeper"))
    per = others.groupBy("doc_id", "uid").agg(
        F.collect_set(F.struct("first", "n")).alias("cover"),
        F.array_sort(F.collect_set("keeper")).alias("keepers"))
    with_cover = rows.join(per.hint("merge"), rows.doc_id.eqNullSafe(per.doc_id)
                           & (rows.uid == per.uid), "left") \
        .select(rows.doc_id, rows.text, "cover", "keepers")

    def clean(batches):
        for b in batches:
            out = []
            for doc_id, text, cover, keepers in zip(*[c.to_pylist() for c in b.columns]):
                at = sentence_bounds(text or "")
                gone = np.zeros(len(at), bool)
                for c in cover or []:
                    gone[c["first"]:c["first"] + c["n"]] = True
                step = np.flatnonzero(np.diff(gone.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
                cuts = [(at[i][0], at[j - 1][1]) for i, j in zip(step[::2].tolist(), step[1::2].tolist())]
                new = text
                if cuts:
                    new = "".join(text[x[1]:y[0]] for x, y in zip([(0, 0), *cuts], [*cuts, (len(text), 0)]))
                out.append((doc_id, len(at), int(gone.sum()),
                            int(sum(Words([text[x:y] for x, y in cuts]).counts)) if cuts else 0,
                            keepers or [], [{"start": x, "end": y} for x, y in cuts], new))
            cols = list(zip(*out)) if out else [()] * 7
            kinds = [*[pa.int64()] * 4, pa.list_(pa.int64()),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "n_sentences", "n_removed", "words_removed", "first_doc_ids",
                       "removed", "text"])
    return with_cover.mapInArrow(
        clean, "doc_id long, n_sentences long, n_removed long, words_removed long, "
               "first_doc_ids array<long>, removed array<struct<start:long,end:long>>, text string")
