"""Sharding, cross-tokenizer alignment and ranked search: against brute force,
and their defined cases."""

import hashlib
import math
import os
import random
import re
import struct
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.llm import lexical_search, queries, sharding, token_align  # noqa: E402

SF = "/root/testdata/sf0.01"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, uid long, size long, shard int, "
          "m long, a int, item long, raw binary")


def table(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, 8, 9, 1, 2, 3, b"x") for i, t in rows], SCHEMA)


LONG = " ".join(f"word{i} is number {i}." for i in range(30_000))
ODD = ["a  b   c    d", "\t\ttabs\n\n\nlines\r\n", "naïve café – “quoted” … €5", "日本語のテキスト", "emoji 🎉🎉 👩‍👩‍👧",
       "<|endoftext|> in <s> text </s> <unk> <0x41>", "▁under▁", "it's I'll WE'VE 123456789 1.5e-10", "\x00\x01\x1c\x85\xa0",
       " leading and trailing ", "ɏɐ", "́combining", "=" * 3000, " " * 500 + "x", "x" * 5000, "؟ العربية",
       "�﻿bom", "ﬁ ligature ½ ²", "Ａ full width"]
ROWS = [(1, None), (2, ""), (3, " "), (4, "one two"), (4, "one two"), (None, "alpha beta"), (5, "alpha beta"),
        (6, LONG), *[(10 + k, t) for k, t in enumerate(ODD)]]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# -- sharding ------------------------------------------------------------------
def descend(doc, tree):
    """The tree's rule, child by child."""
    def draw(level, child, weight):
        h = 42
        for v in (sharding.SEED, level, child, doc):
            if v is not None:           # a null leaves the hash as it is
                h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
        return -math.log(((h >> 11) + 0.5) / float(1 << 53)) / weight
    own = list(tree)
    for level in range(3):
        kids = defaultdict(float)
        for s in own:
            kids[s[level]] += s.weight
        best = min((draw(level, k, w), k) for k, w in kids.items())[1]
        own = [s for s in own if s[level] == best]
    return own[0].shard


def check_shards(rows, docs):
    sixteen, more = sharding.layout(16), sharding.layout(17)
    key = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows)
    want = Counter()
    for i, t in docs:
        raw = (t or "").encode()
        want[i, len(raw) + 1, zlib.crc32(raw), descend(i, sixteen), descend(i, more)] += 1
    assert key == want
    assert all(r.law == "key" and r.grown_shard in (r.shard, 16) for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_op11_matches_brute_force(spark):
    rows = queries.QUERIES["op11_hash_tree_shards"](spark, SF).collect()
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    check_shards(rows, docs)
    assert all(abs(n - len(docs) / 16) < 6 * (len(docs) / 16) ** 0.5 for n in Counter(r.shard for r in rows).values())


def test_shard_cases(spark, odd, none):
    check_shards(sharding.place(odd, sharding.layout(16), sharding.layout(17)).collect(), ROWS)
    assert sharding.place(none, sharding.layout(16), sharding.layout(17)).count() == 0
    with pytest.raises(ValueError):
        sharding.descend(None, [sharding.Shard(0, 0, 0), sharding.Shard(1, 0, 1)])
    with pytest.raises(ValueError):
        sharding.descend(None, [sharding.Shard(0, 0, 0, 0.0)])


def test_movement_stays_in_the_changed_subtree(spark):
    ids = frame(spark, [(i, None) for i in range(4000)])
    old = [sharding.Shard(s.region, s.rack, s.shard, 1.0 + s.shard % 3) for s in sharding.layout(12)]
    new = [s._replace(weight=s.weight * 3) if s.shard == 5 else s for s in old]
    rows = sharding.place(ids, old, new).collect()
    place = {s.shard: s for s in old}
    n = Counter(r.shard for r in rows)
    total = sum(s.weight for s in old)
    assert all(abs(n[s.shard] - 4000 * s.weight / total) < 6 * (4000 * s.weight / total) ** 0.5 for s in old)
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert moved
    for r in moved:     # to the changed region, within it to the changed rack, within that to the changed shard
        a, b = place[r.shard], place[r.grown_shard]
        assert b.region == 0
        if a.region == 0:
            assert b.rack == 1
            if a.rack == 1:
                assert b.shard == 5


# -- alignment -----------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_of():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    for k, b in enumerate(x for x in range(256) if x not in shown):
        out[chr(256 + k)] = b
    return out


def brute_align(docs, tok_a, tok_b):
    decode = byte_of()
    per, held = [], defaultdict(set)
    for k, (i, t) in enumerate(docs):
        if not t:
            per.append((i, 0, 0, 0, [], ""))
            continue
        raw = (" " + t).encode()
        a = tok_a.encode(" " + t, add_special_tokens=False)
        b = tok_b.encode(t)
        ab = [bytes(decode[c] for c in s) for s in a.tokens]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
              for p in map(tok_b.id_to_piece, b)]
        if b"".join(ab) != raw or b"".join(bb) != raw:
            per.append((i, 0, 0, 0, [], ""))
            continue
        ea, eb = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        cuts = sorted(set(ea) & set(eb))
        groups = [([], []) for _ in cuts]
        for ids, ends, side in ((a.ids, ea, 0), (b, eb, 1)):
            g = 0
            for x, e in zip(ids, ends):
                while e > cuts[g]:
                    g += 1
                groups[g][side].append(x)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        for p in links:
            held[p].add(k)
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        per.append((i, len(a.ids), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
    most = Counter()
    for (x, _), docs_ in held.items():
        most[x] = max(most[x], len(docs_))
    out = Counter()
    for i, na, nb, ng, links, sha in per:
        c = Counter(links)
        out[i, na, nb, ng, c.total(), sum(m for p, m in c.items() if len(held[p]) == most[p[0]]),
            sum(m * len(held[p]) for p, m in c.items()), sha] += 1
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def as_counter(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_op12_matches_brute_force(spark, tokenizers):
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    assert as_counter(queries.QUERIES["op12_pair_bitmaps"](spark, SF)) == brute_align(docs, *tokenizers)


@pytest.mark.parametrize("small", [False, True])
def test_alignment_cases(spark, odd, none, tokenizers, monkeypatch, small):
    if small:       # chunks closed early, batches of a text, large groups, dense bitmaps
        for name, v in (("POSTINGS", 50), ("BATCH", 20), ("GROUP", 0), ("SLAB", 7)):
            monkeypatch.setattr(token_align, name, v)
    rows = [r for r in ROWS if r[1] != LONG] if small else ROWS
    assert as_counter(token_align.align(frame(spark, rows))) == brute_align(rows, *tokenizers)
    assert token_align.align(none).count() == 0


def test_fast_encoder_is_the_reference(tokenizers):
    own = token_align.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    assert own.fast is not None
    rnd = random.Random(7)
    chars = [chr(c) for c in range(0x250)] + list(" \n\t'sdltre0123") * 40
    texts = ["".join(rnd.choices(chars, k=rnd.randrange(1, 60))) for _ in range(4000)] + ODD
    assert [x.tolist() for x in own.encode(texts)] == \
        [tokenizers[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_bitmaps_round_trip():
    rnd = np.random.default_rng(3)
    keys, times = [], []
    for pair, n in ((3, 1), (4, 4095), (7, 4096), (9, 60_000), (10, 5)):
        at = np.sort(rnd.choice(token_align.CHUNK, n, replace=False))
        keys.append(pair * token_align.CHUNK + at)
        times.append(rnd.integers(1, 9, n))
    keys, times = np.concatenate(keys), np.concatenate(times)
    b = token_align.index_rows(keys, times, 5, 4)
    got = Counter()
    for lo, hi in ((0, 2), (2, 5)):
        row, plane, at = token_align.positions(b.column(5).slice(lo, hi - lo))
        for r, p, x in zip(row.tolist(), plane.tolist(), at.tolist()):
            r += lo
            got[(b["a"][r].as_py() * 4 + b["b"][r].as_py()) * token_align.CHUNK + x] += 1 << max(p - 1, 0)
    assert got == dict(zip(keys.tolist(), times.tolist()))
    assert b["n_docs"].to_pylist() == [1, 4095, 4096, 60_000, 5]
    assert sum(b["pair_links"].to_pylist()) == times.sum()


def test_pair_counts(spark, tokenizers):
    """The index's popcounts: documents and links of every pair."""
    docs = [(k, "the cat sat on the mat " * k) for k in range(1, 12)]
    both = token_align.aligned(frame(spark, docs), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN,
                               "doc_id", "text")
    got = {(r.a, r.b): (r["count"], r.pair_links) for r in
           token_align.counts(both.where("chunk is not null")).collect()}
    x, y = token_align._loaded(public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    n, links = Counter(), Counter()
    for _, t in docs:
        own = Counter()
        for _, a, b, times in token_align.Aligned([t], x, y).links():
            for p, m in zip(zip(a.tolist(), b.tolist()), times.tolist()):
                own[p] += m
        n.update(own.keys())
        links.update(own)
    assert got == {p: (n[p], links[p]) for p in n}


# -- ranked search ---------------------------------------------------------------
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_search(docs, items, k=50):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    full = [(i, c) for i, c in bags if c]
    n_docs, size = len(full), sum(c.total() for _, c in full)
    df = Counter(t for _, c in full for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms_of(t))
    out = Counter()
    for item, terms in asked.items():
        got = []
        for i, c in full:
            m = 100 - 50 + (50 * c.total() * n_docs) // size
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                got.append((-s, i is None, i or 0, i))
        for r, (s, _, _, i) in enumerate(sorted(got, key=lambda x: x[:3])[:k]):
            out[item, r + 1, i, -s] += 1
    return out


def found(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_op13_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in table("documents")]
    items = [(d["item_id"], d["text"]) for d in table("benchmark")]
    assert found(queries.QUERIES["op13_length_strata"](spark, SF)) == brute_search(docs, items)


ITEMS = [(1, "ONE, two; word7"), (2, None), (3, ""), (4, "!!"), (None, "alpha"), (5, "nowhere"), (6, "is is IS number"),
         (6, "beta"), (7, "日本語のテキスト café")]


@pytest.mark.parametrize("first", [1, 10_000])
@pytest.mark.parametrize("pairs", [1 << 18, 3])
def test_search_cases(spark, odd, none, monkeypatch, first, pairs):
    monkeypatch.setattr(lexical_search, "SLICE_POSTINGS", 3)
    monkeypatch.setattr(lexical_search, "SPREAD", 2)
    monkeypatch.setattr(lexical_search, "PIECE", 1000)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(lexical_search.search(odd, items, first=first, pairs=pairs)) == brute_search(ROWS, ITEMS)
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0


def test_threshold_ties_and_repeats(spark):
    """More documents tie at the k-th score than there is room for."""
    rows = [(i % 150, "alpha beta " + "gamma " * (i % 4)) for i in range(300)]
    items = [(1, "alpha"), (2, "gamma alpha"), (3, "beta delta")]
    for first in (1, 40, 1000):
        got = lexical_search.search(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"),
                                    first=first)
        assert found(got) == brute_search(rows, items)
