"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers cut the same bytes; byte offsets where tokens of both end part
a text into groups, and all tokens of a group are linked across the two sides.
How well a link is supported is the number of documents that hold its pair of
ids linked anywhere.

The pairs' postings are inverted while the texts are tokenized: a task gathers
the postings of a chunk of up to 65,536 consecutive documents and writes, per
pair, a compressed bitmap of the chunk's documents (sorted 16-bit positions, or
8 KB of bits from 4,096 documents on). Batches are OR-merged into it, so that
its popcount is the pair's number of documents in the chunk. Further bitmaps
hold the multiplicity minus one, one plane per binary digit: the popcounts of
the planes, each by its power of two, plus that of the documents give the
pair's links. Chunks are disjoint, so the popcounts of all chunks add up
(partial sums before the shuffle) to the counts; a maximum per id of the first
tokenizer, one row an id, marks the best pairs. The postings then return the
scores: each bitmap row takes its pair's count, goes to its chunk's task, and
adds the count to its documents, once for the bitmap and by powers of two for
the planes.

A task holds one batch of texts and one chunk's postings (POSTINGS at most
before the chunk is closed, unless a single document has more); a returning
task holds two numbers per document of a chunk. A pair in all documents has
one row of at most 8 KB a plane in each chunk.

Defined cases: null and empty texts, and texts whose joined token bytes differ
from space + text on either side, have no tokens (zeros and an empty digest);
repeated rows are documents of their own and all count; ties for the highest
count are all best; very long texts are tokenized whole, and a group too large
to enumerate is counted by distinct ids; a null doc_id is kept; an empty table
gives no rows; other columns are unused and may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CHUNK = 1 << 16              # documents that a bitmap's 16-bit positions reach
POSTINGS = 4 << 20           # postings after which a chunk is closed early
DENSE = 4096                 # documents from which a bitmap is kept as bits
BITS = CHUNK // 8
BATCH = 1 << 21              # characters of texts aligned at once
GROUP = 1 << 16              # links of a group above which it is counted by distinct ids
SLAB = 4 << 20               # links enumerated at once
PLAIN = 1 << 17              # length up to which a text takes the faster encoder
LATIN = "ɏ"             # and the highest character for it


class ByteBpe:
    """Byte-level BPE of a tokenizers file: ids and bytes of tokens.

    Short Latin texts take tiktoken with the file's own vocabulary as ranks,
    if the file's merges are in the order of their ids, which makes the two
    the same; others take the tokenizers library, whose tables of characters
    are the file's reference.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        decode = byte_alphabet()
        own = {t: bytes(decode[c] for c in t) for t in vocab}
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.bytes = [b""] * self.size
        for t, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = own[t] if t in own else t.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ordered = [vocab["".join(m)] for m in merges]
        self.fast = None
        if len(set(ordered)) == len(ordered) and ordered == sorted(ordered):
            self.fast = tiktoken.Encoding("file", pat_str=pattern, special_tokens={},
                                          mergeable_ranks={own[t]: i for t, i in vocab.items()})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.fast is not None and len(t) <= PLAIN and max(t) <= LATIN for t in texts]
        rest = [t for t, p in zip(texts, plain) if not p]
        slow = iter([np.array(e.ids, np.int64) for e in
                     self.tok.encode_batch_fast(rest, add_special_tokens=False)] if rest else ())
        return [self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int64) if p else next(slow)
                for t, p in zip(texts, plain)]


def byte_alphabet() -> dict[str, int]:
    """Character of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class PieceBpe:
    """A sentencepiece model: ids and bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.tok = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.tok.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.tok.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.tok.id_to_piece(i)) for i in range(self.size))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.tok.encode(texts, num_threads=1)]


_LOADED: dict = {}


def _loaded(a: str, b: str, pattern: str):
    """The two tokenizers and their tables, kept by a worker between tasks."""
    if (a, b) not in _LOADED:
        x, y = ByteBpe(a, pattern), PieceBpe(b)
        for t in (x, y):
            t.lens = np.array([len(s) for s in t.bytes], np.int64)
            t.marked = np.array([f"{i}{s}" for i in range(t.size) for s in (",;" if t is y else ",|")], object)
        _LOADED[a, b] = x, y
    return _LOADED[a, b]


class Aligned:
    """Groups and links of some texts (none empty) under two tokenizers."""

    def __init__(self, texts: list[str], x: ByteBpe, y: PieceBpe):
        spaced = [" " + t for t in texts]
        both = [(a, b) if self._whole(x, a, s) and self._whole(y, b, s) else (a[:0], b[:0])
                for a, b, s in zip(x.encode(spaced), y.encode(texts), (s.encode() for s in spaced))]
        self.x, self.y = x, y
        self.a = np.concatenate([a for a, _ in both])
        self.b = np.concatenate([b for _, b in both])
        self.n_a = np.array([len(a) for a, _ in both], np.int64)
        self.n_b = np.array([len(b) for _, b in both], np.int64)
        # bytes of the two sides are equal text by text, so offsets over all
        # texts at once part them alike, and each text's end parts groups
        end_a, end_b = np.cumsum(x.lens[self.a]), np.cumsum(y.lens[self.b])
        size = int(end_a[-1]) + 1 if len(end_a) else 1
        mark = np.zeros(size, bool)
        mark[end_b] = True
        self.last_a = mark[end_a]
        mark[:] = False
        mark[end_a] = True
        self.last_b = mark[end_b]
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        groups = int(self.last_a.sum())
        self.of_a = np.bincount(self.group_a, minlength=groups)
        self.of_b = np.bincount(self.group_b, minlength=groups)
        self.start_b = np.cumsum(self.of_b) - self.of_b
        self.start_a = np.cumsum(self.of_a) - self.of_a
        first = np.concatenate([[0], np.cumsum(self.last_a)])[np.cumsum(self.n_a)] if groups else \
            np.zeros(len(texts), np.int64)
        self.n_groups = np.diff(first, prepend=0)
        links = np.concatenate([[0], np.cumsum(self.of_a * self.of_b)])
        self.n_links = np.diff(links[first], prepend=0)
        self.doc = np.repeat(np.arange(len(texts)), self.n_groups)       # of each group

    @staticmethod
    def _whole(tok, ids: np.ndarray, raw: bytes) -> bool:
        return b"".join(map(tok.bytes.__getitem__, ids.tolist())) == raw

    def digests(self) -> list[str]:
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + self.start_b[self.group_a]] = self.x.marked[2 * self.a + self.last_a]
        out[np.arange(len(self.b)) + (self.start_a + self.of_a)[self.group_b]] = \
            self.y.marked[2 * self.b + self.last_b]
        ends = np.cumsum(self.n_a + self.n_b)
        return [hashlib.sha256("".join(out[e - n:e].tolist())[:-1].encode()).hexdigest() if n else ""
                for e, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist())]

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(doc, a id, b id, times) of links, in slabs; the large groups' by
        distinct ids."""
        large = self.of_a * self.of_b > GROUP
        width = np.where(large[self.group_a], 0, self.of_b[self.group_a])
        step, lo = np.cumsum(width), 0
        while lo < len(self.a):
            hi = max(lo + 1, int(np.searchsorted(step, step[lo] - width[lo] + SLAB, "right")))
            w, g = width[lo:hi], self.group_a[lo:hi]
            at = np.repeat(self.start_b[g], w) + np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
            yield np.repeat(self.doc[g], w), np.repeat(self.a[lo:hi], w), self.b[at], np.ones(len(at), np.int64)
            lo = hi
        for g in np.flatnonzero(large):
            a, ca = np.unique(self.a[self.start_a[g]:self.start_a[g] + self.of_a[g]], return_counts=True)
            b, cb = np.unique(self.b[self.start_b[g]:self.start_b[g] + self.of_b[g]], return_counts=True)
            rows = max(1, SLAB // len(b))
            for k in range(0, len(a), rows):
                x, c = a[k:k + rows], ca[k:k + rows]
                yield (np.full(len(x) * len(b), self.doc[g]), np.repeat(x, len(b)), np.tile(b, len(x)),
                       np.outer(c, cb).ravel())


class Postings:
    """Postings of a chunk: sorted keys (pair * CHUNK + position) and times."""

    def __init__(self):
        self.keys, self.times, self.new, self.size = [], [], 0, 0

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(keys)
        self.times.append(times)
        self.new += len(keys)
        if self.new > POSTINGS // 2:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """OR-merge what was added: equal keys become one, times add up."""
        keys, times = np.concatenate(self.keys or [np.zeros(0, np.int64)]), \
            np.concatenate(self.times or [np.zeros(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        if len(first) < len(keys):
            keys, times = keys[first], np.add.reduceat(times, first)
        self.keys, self.times, self.new, self.size = [keys], [times], 0, len(keys)
        return keys, times


def containers(slot: np.ndarray, at: np.ndarray, slots: int) -> pa.Array:
    """One container per slot from its positions (sorted by slot, position)."""
    many = np.bincount(slot, minlength=slots)
    at = at.astype("<u2")
    dense = many >= DENSE
    size = np.where(dense, BITS, 2 * many)
    ends = np.cumsum(many)
    if dense.any():
        parts, lo = [], 0
        for s in np.flatnonzero(dense):
            bits = np.zeros(CHUNK, np.uint8)
            bits[at[ends[s] - many[s]:ends[s]]] = 1
            parts += [at[lo:ends[s] - many[s]].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
            lo = ends[s]
        data = b"".join([*parts, at[lo:].tobytes()])
    else:
        data = at.tobytes()
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), slots, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def positions(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, plane, position) of every set bit of the rows' containers."""
    ends = planes.offsets.to_numpy()
    inner = planes.values.slice(ends[0], ends[-1] - ends[0])
    of = np.frombuffer(inner.buffers()[1], np.int32)[inner.offset:inner.offset + len(inner) + 1].astype(np.int64)
    slots = np.diff(ends)
    row = np.repeat(np.arange(len(planes)), slots)
    plane = np.arange(len(inner)) - np.repeat(np.cumsum(slots) - slots, slots)
    size = np.diff(of)
    raw = np.frombuffer(inner.buffers()[2], np.uint8)[of[0]:of[-1]] if len(inner) and of[-1] > of[0] else \
        np.zeros(0, np.uint8)
    dense = size == BITS
    if not dense.any():
        return np.repeat(row, size // 2), np.repeat(plane, size // 2), raw.view("<u2").astype(np.int64)
    out = []
    for s in range(len(inner)):
        own = raw[of[s] - of[0]:of[s + 1] - of[0]]
        at = np.flatnonzero(np.unpackbits(own, bitorder="little")) if dense[s] else own.view("<u2")
        out.append(at.astype(np.int64))
    many = [len(x) for x in out]
    return np.repeat(row, many), np.repeat(plane, many), np.concatenate(out)


def index_rows(keys: np.ndarray, times: np.ndarray, chunk: int, pieces: int) -> pa.RecordBatch:
    """Bitmap rows of a chunk: (a, b, chunk, n_docs, n_pairs, planes)."""
    pair, at = keys // CHUNK, keys % CHUNK
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    row = np.cumsum(np.append(True, pair[1:] != pair[:-1])) - 1
    more = times - 1
    digits = np.frexp(np.maximum.reduceat(more, first).astype(np.float64))[1].astype(np.int64)
    start = np.cumsum(1 + digits) - (1 + digits)                 # slot of the documents' bitmap
    slot, spot = [start[row]], [at]
    for k in range(int(digits.max())):
        has = np.flatnonzero((more >> k) & 1)
        slot.append(start[row[has]] + 1 + k)
        spot.append(at[has])
    slot, spot = np.concatenate(slot), np.concatenate(spot)
    order = np.argsort(slot, kind="stable")
    inner = containers(slot[order], spot[order], int(start[-1] + 1 + digits[-1]))
    planes = pa.ListArray.from_arrays(pa.array(np.append(start, start[-1] + 1 + digits[-1]), pa.int32()), inner)
    # popcounts of what was encoded: documents, and links by the planes' powers
    bits = np.bincount(slot, minlength=len(inner))
    power = np.arange(len(inner)) - np.repeat(start, 1 + digits)
    links = np.add.reduceat(bits << np.maximum(power - 1, 0), start)
    return pa.RecordBatch.from_arrays(
        [pa.array(pair[first] // pieces, pa.int32()), pa.array(pair[first] % pieces, pa.int32()),
         pa.array(np.full(len(first), chunk), pa.int64()), pa.array(bits[start], pa.int64()),
         pa.array(links, pa.int64()), planes], names=["a", "b", "chunk", "n_docs", "pair_links", "planes"])


DOC = "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ROW = "a int, b int, chunk long, n_docs long, pair_links long, planes array<binary>"


def aligned(docs: DataFrame, byte_bpe: str, piece_bpe: str, pattern: str, id_col: str,
            text_col: str) -> DataFrame:
    """One written table of two kinds of rows: documents (DOC; ``chunk`` is
    null) and the inverted index (ROW; ``uid`` is null)."""
    doc_kinds = [pa.int64()] * 6 + [pa.string()]
    row_kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.binary())]
    names = [x.split()[0] for x in f"{DOC}, {ROW}".split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = _loaded(byte_bpe, piece_bpe, pattern)
        held, chunk = Postings(), None

        def closed():
            keys, times = held.merge()
            if len(keys):
                own = index_rows(keys, times, chunk, y.size)
                yield pa.RecordBatch.from_arrays([pa.nulls(own.num_rows, k) for k in doc_kinds] + own.columns,
                                                 names=names)
        for b in batches:
            sizes = np.cumsum(np.maximum(np.array(b.column(2).fill_null(0)), 1))
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BATCH, "right")))
                hi = min(hi, lo + CHUNK)
                uid, ids, _, texts = (c[lo:hi] for c in b.columns)
                lo = hi
                uid, texts = np.array(uid), texts.to_pylist()
                full = [k for k, t in enumerate(texts) if t]
                own = Aligned([texts[k] for k in full], x, y) if full else None
                out = np.zeros((4, len(texts)), np.int64)
                sha = [""] * len(texts)
                if own is not None:
                    for o, v in zip(out, (own.n_a, own.n_b, own.n_groups, own.n_links)):
                        o[full] = v
                    for k, d in zip(full, own.digests()):
                        sha[k] = d
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid), ids, *[pa.array(o) for o in out], pa.array(sha)]
                    + [pa.nulls(len(texts), k) for k in row_kinds], names=names)
                if own is None:
                    continue
                if chunk is None or uid[-1] - chunk >= CHUNK or held.size + held.new > POSTINGS:
                    if chunk is not None:
                        yield from closed()
                    held, chunk = Postings(), int(uid[0])
                spot = (uid - chunk)[full]
                for doc, a, bb, times in own.links():
                    held.add((a * y.size + bb) * CHUNK + spot[doc], times)
        if chunk is not None:
            yield from closed()
    return cut(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"),
                           F.length(text_col).alias("size"), F.col(text_col).cast("string").alias("text"))
               .mapInArrow(run, f"{DOC}, {ROW}"), "align-index")


def counts(index: DataFrame) -> DataFrame:
    """(a, b, count, pair_links, best): documents and links of every pair;
    best: its count is the highest of its id a (ties included)."""
    pairs = cut(index.groupBy("a", "b").agg(F.sum("n_docs").alias("count"),
                                            F.sum("pair_links").alias("pair_links")), "align-pairs")
    # one row per id of the first tokenizer: bounded by its vocabulary
    most = pairs.groupBy("a").agg(F.max("count").alias("_most"))
    return pairs.join(F.broadcast(most), "a").select("a", "b", "count", "pair_links",
                                                     (F.col("count") == F.col("_most")).alias("best"))


def returned(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, n_best, count_sum): the postings return their pairs' scores."""
    spark = index.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = (index.select("a", "b", "chunk", "planes")
            .join(pairs.select("a", "b", "count", "best").hint("merge"), ["a", "b"])
            .select("chunk", "count", "best", "planes").repartition(n, "chunk").sortWithinPartitions("chunk"))

    def run(batches):
        chunk = total = None

        def closed():
            at = np.flatnonzero(total[1])
            yield pa.RecordBatch.from_arrays([pa.array(chunk + at), pa.array(total[0][at]), pa.array(total[1][at])],
                                             names=["uid", "n_best", "count_sum"])
        for b in batches:
            chunks = np.array(b.column(0))
            count = np.array(b.column(1))
            best = np.array(b.column(2)).astype(np.int64)
            edges = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1]))
            for lo, hi in zip(edges, [*edges[1:], len(chunks)]):
                if chunk is None or chunks[lo] != chunk:
                    if chunk is not None:
                        yield from closed()
                    chunk, total = int(chunks[lo]), np.zeros((2, CHUNK), np.int64)
                row, plane, at = positions(b.column(3).slice(lo, hi - lo))
                times = np.int64(1) << np.maximum(plane - 1, 0)
                np.add.at(total[0], at, best[lo:hi][row] * times)
                np.add.at(total[1], at, count[lo:hi][row] * times)
        if chunk is not None:
            yield from closed()
    return rows.mapInArrow(run, "uid long, n_best long, count_sum long")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str | None = None,
          piece_bpe: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    per row. ``byte_bpe`` is the path of a byte-level tokenizers file on the
    workers, ``pattern`` its splitting pattern, ``piece_bpe`` that of a
    sentencepiece model with byte fallback."""
    if None in (byte_bpe, piece_bpe, pattern):
        import public_tokenizers as given

        byte_bpe = byte_bpe or given.path(BYTE_BPE)
        piece_bpe = piece_bpe or given.path(PIECE_BPE)
        pattern = pattern or given.PATTERN
    both = aligned(docs, byte_bpe, piece_bpe, pattern, id_col, text_col)
    index = both.where("chunk is not null")
    back = returned(index, counts(index))
    zero = F.lit(0).cast("long")
    return (both.where("uid is not null").join(back, "uid", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"))
