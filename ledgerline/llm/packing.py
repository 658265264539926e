"""Sequence packing along a space-filling curve.

Documents become token ids with an end id. Every token id has a fixed random
direction (a hash of the id); a document's vector is the sum over its tokens,
projected to a few dimensions by construction. The vectors are standardised,
put on a grid and numbered by the Hilbert curve through it; documents in
Hilbert order are laid end to end and cut every ``length`` tokens, so that
neighbours on the curve share sequences and only the very last sequence is
padded. Positions come from distributed prefix sums over narrow rows; the
token ids are written once and shuffled once.

Defined cases: null and empty texts are the end id alone; repeated rows are
packed once each; rows with a null id are packed like others; texts of any
length are cut over as many sequences as they need; an empty table gives no
piece; other columns are unused.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prefix_sums, small_batches

TOKENIZER = "word_bpe_49k.json"
LENGTH = 2048
END_ID = 1
DIMS = 4
BITS = 10
CACHE = 300_000              # words in each of a worker's two generations of remembered words, besides a group's new ones
CACHED = 64                  # characters of the longest of them: a generation is 50 MB as a rule, 160 MB at most
GROUP = 4_000_000            # bytes of text that are encoded at once: their distinct chunks are looked up once
PUNCT = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# What a tokenizer does before its model, for which a run of lower-case Latin-1 letters is one word as it stands.
WORDS = {"normalizer": {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}


class Encoder:
    """Token ids of texts, by a bounded cache of words.

    The tokenizer drops white space and never merges across it, so a text's
    ids are those of its chunks between spaces and newlines, in order. Chunks
    new to the cache are encoded by the tokenizer itself: letter runs many at
    once, told apart by the end-of-word mark (lower-case Latin-1 ones without
    its normalizer and pattern, which leave them as they are), runs of punctuation after them
    once each (the tokenizer parts letters from what follows), all else one at
    a time. Chunks of more than CACHED characters are not remembered.

    A batch's chunks are split, told apart and put back in order by Arrow;
    Python looks at each distinct chunk of the batch once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = self.words = Tokenizer.from_file(path)
        made = json.loads(self.tok.to_str())
        if all(made[k] == v for k, v in WORDS.items()):
            self.words = Tokenizer(self.tok.model)
            self.words.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.size = size
        self.last = np.zeros(size, bool)
        for t, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.last[i] = t.endswith("</w>")
        self.cache: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}          # the generation before; words still in use move over

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The worker process's encoder for this file, kept between its tasks."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _runs(self, words: list[str]) -> None:
        """Cache letter runs (ASCII or any letters, one end-of-word each)."""
        kinds = [w for w in words if w.isascii()], [w for w in words if not w.isascii()]
        for part in (kind[lo:lo + 128] for kind in kinds for lo in range(0, len(kind), 128)):
            text = " ".join(part)
            tok = self.words if _latin(text) and text == text.lower() else self.tok
            enc = tok.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(enc.ids, self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and (not len(ids) or ends[-1] == len(ids)):
                raw, at = ids.tobytes(), [0, *(ends * ids.itemsize).tolist()]
                self.cache.update(zip(part, map(raw.__getitem__, map(slice, at, at[1:]))))
            else:
                for w in part:
                    self.cache[w] = self._ids(w)

    def learn(self, chunks: list[str]) -> None:
        """Cache chunks that the cache does not hold."""
        cache, old, tails, rest = self.cache, self.old, [], []
        if old:
            cache.update((c, old[c]) for c in chunks if c in old)
            chunks = [c for c in chunks if c not in cache]
        runs = {c for c in chunks if c.isalpha()}
        for c in chunks:
            if c in runs:
                continue
            head = c.rstrip(PUNCT)
            if not head.isalpha():
                rest.append(c)
                continue
            tail = c[len(head):]
            tails.append((c, head, tail))
            for part in (head, tail):
                if part not in cache and part in old:
                    cache[part] = old[part]
            if head not in cache:
                runs.add(head)
            if tail not in cache:
                cache[tail] = self._ids(tail)
        self._runs(list(runs))
        cache.update((c, cache[head] + cache[tail]) for c, head, tail in tails)
        for c in rest:
            cache[c] = self._ids(c)

    def encode(self, texts: list[str | None], end: bytes) -> list[bytes]:
        docs = pc.split_pattern(pa.array([_lower(t or "").replace("\n", " ") for t in texts], pa.large_string()), " ")
        words = docs.flatten().dictionary_encode()
        # no chunk holds a space: one string, split, is the list of them
        seen = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()),
                                                       words.dictionary.cast(pa.string())), " ")[0].as_py().split(" ")
        if len(self.cache) > CACHE:
            self.cache, self.old = {"": b""}, self.cache
        cache = self.cache
        new = [c for c in seen if c not in cache]
        long = [c for c in new if len(c) > CACHED]
        self.learn([c for c in new if len(c) <= CACHED] if long else new)
        once = {c: self._ids(c) for c in long}
        ids = pa.array([once[c] if c in once else cache[c] for c in seen] if once else list(map(cache.__getitem__, seen)),
                       pa.large_binary()).take(words.indices)
        # the taken values lie end to end: a text's ids are one stretch of them
        _, ends, raw = ids.buffers()
        at = np.frombuffer(ends, np.int64, len(ids) + 1)[docs.offsets.to_numpy()].tolist() if len(ids) else [0]
        raw = memoryview(raw or b"")
        return [b"".join((raw[lo:hi], end)) for lo, hi in zip(at, at[1:])]


_ENCODERS: dict[str, Encoder] = {}


def grouped(batches: Iterator[pa.RecordBatch], size: int = GROUP) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes, or as they came if larger."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _lower(text: str) -> str:
    """The tokenizer lower-cases; doing so first shares cache entries, and is
    the same where all characters are Latin-1."""
    return text.lower() if _latin(text) else text


def directions(size: int, dims: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(20240611)).standard_normal(
        (size, dims), np.float32)


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (n, dims), by
    undoing, bit by bit from the top, the curve's reflections and swaps."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            hit = (x[:, i] & q) > 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(hit, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, dims - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def tokenized(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int,
              dims: int) -> DataFrame:
    """(doc_id, n, ids, v array<float>) per row: ids as little-endian bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.of_worker(path)
        table = directions(max(enc.size, end_id + 1), dims)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        for b in grouped(batches):
            ids = enc.encode(b.column(1).to_pylist(), end)
            n = np.array([len(x) // width for x in ids], np.int64)
            flat = np.frombuffer(b"".join(ids), enc.dtype)
            at = np.cumsum(n) - n
            v = np.stack([np.add.reduceat(table[:, d][flat], at) for d in range(dims)], 1)
            v /= np.sqrt(n)[:, None]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(ids, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * dims, pa.int32()),
                                          pa.array(v.ravel().astype(np.float32)))],
                names=["doc_id", "n", "ids", "v"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n long, ids binary, v array<float>")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         dims: int = DIMS, bits: int = BITS, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])
    per piece; ``tokenizer`` is the path of a tokenizers file on the workers."""
    spark = docs.sparkSession
    small_batches(spark)
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    path = tokenizer
    t = cut(tokenized(docs, path, id_col, text_col, end_id, dims)
            .withColumn("uid", F.monotonically_increasing_id()), "pack-tokens")
    stats = t.agg(*[f(F.col("v")[d].cast("double")).alias(f"{k}{d}") for d in range(dims)
                    for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    centre = [stats[f"m{d}"] or 0.0 for d in range(dims)]
    spread = [stats[f"s{d}"] or 1.0 for d in range(dims)]

    def key(batches):
        for b in batches:
            v = np.array(b.column(2).flatten()).reshape(-1, dims).astype(np.float64)
            z = (v - centre) / spread
            cells = np.minimum((1 << bits) - 1, (1 << bits) / (1 + np.exp(-1.702 * z))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1),
                                              pa.array(hilbert_index(cells, bits))],
                                             names=["uid", "n", "hilbert"])
    order = t.select("uid", "n", "v").mapInArrow(key, "uid long, n long, hilbert long")
    placed = prefix_sums(order, ["hilbert", "uid"], {"at": "n"}, "pack-order").select("uid", "at")
    rows = t.select("uid", "doc_id", "n", "ids").join(placed.hint("merge"), "uid") \
        .select("doc_id", "n", "ids", "at")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pieces(batches):
        for b in batches:
            out = []
            for doc, n, raw, at in zip(*[c.to_pylist() for c in b.columns]):
                ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                start = 0
                while start < n:
                    seq, off = divmod(at + start, length)
                    size = min(length - off, n - start)
                    part = ids[start:start + size].tobytes()
                    out.append((doc, start, size, zlib.crc32(part), n, seq, off,
                                part if with_ids else None))
                    start += size
            cols = list(zip(*out)) if out else [()] * 8
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0] + [len(p) // 4 for p in cols[7]]), pa.int32()),
                    pa.array(np.frombuffer(b"".join(cols[7]), "<i4"))))
            yield pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * with_ids)
    return rows.mapInArrow(pieces, ", ".join(f"{c} long" for c in names)
                           + ", ids array<int>" * with_ids)
