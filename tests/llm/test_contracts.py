"""Registered queries against brute force over the whole small tables."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerline.llm import ann, lattice_lm, lz_fingerprint, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def docs():
    return table("documents")


def run(spark, name, sf=SF):
    return queries.QUERIES[name](spark, sf).collect()


def test_op1_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in table("labels", sf)}
    rows = run(spark, "op1_toxicity", sf)
    assert len(rows) == 10000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    found = sum(p for y, p in held if y)
    assert found >= 0.6 * sum(y for y, _ in held)
    assert sum(p for y, p in held if not y) <= 0.05 * len(held)


def test_op2_matches_brute_force(spark, docs):
    sets = {}
    for d in docs:
        w = WORD.findall(lower(d["text"]))
        sets[d["doc_id"]] = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5
                             else {tuple(w)} if w else set())
    by = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by[x].add(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    common = Counter()
    for ids in by.values():
        common.update(itertools.combinations(sorted(ids), 2))
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = run(spark, "op2_minhash_near_dup")
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))
        assert r.kept == (r.doc_id == r.component_id)


def test_op3_removes_repeats_and_nothing_else(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op3_sentence_spans")}
    text = {d["doc_id"]: d["text"] for d in docs}
    assert set(got) == set(text)
    for i, r in got.items():
        spans = [(s.start, s.end) for s in r.removed]
        kept = "".join(text[i][a[1]:b[0]] for a, b in zip([(0, 0), *spans], [*spans, (len(text[i]), 0)]))
        assert r.text == kept and (r.n_removed == 0) == (not spans)
    first = {}
    for i in sorted(text):       # exact copies: the first one keeps its words, unless a span of it repeats earlier
        w = len(WORD.findall(text[i]))
        if text[i] in first and w > 100 and got[first[text[i]]].n_removed == 0:
            assert got[i].words_removed > 0.8 * w
        first.setdefault(text[i], i)
    assert sum(r.n_removed > 0 for r in got.values()) < 0.25 * len(got)


def test_op4_pieces_hold_every_id_once(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in run(spark, "op4_hilbert_packing"):
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for d in docs:
        ids = tok.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(pieces[d["doc_id"]], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:at], "<u4").tobytes())
        assert at == len(ids)
    short = 0
    for own in places.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at <= 2048
        short += at < 2048
    assert short <= 1


def test_op5_fingerprints(spark, docs):
    docs = sorted(docs, key=lambda d: d["doc_id"])
    got = {r.doc_id: r for r in run(spark, "op5_lz_fingerprint")}
    hasher = lz_fingerprint.Hasher()

    def phrases(t):
        out, start, seen = [], 0, set()
        for e in range(1, len(t) + 1):
            if t[start:e] not in seen:
                seen.add(t[start:e])
                out.append(t[start:e])
                start = e
        return out

    def mark(t):
        ends = list(itertools.accumulate(map(len, phrases(t))))
        return lz_fingerprint.smallest(hasher.spans(t, ends, 0), lz_fingerprint.SIZE)
    better = 0
    for a, b in zip(docs, docs[1:] + docs[:1]):
        r, t, u = got[a["doc_id"]], a["text"], b["text"]
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        f, g, h = mark(t), mark(edited), mark(u)
        assert (r.fingerprint, r.edited_fingerprint) == (f.tobytes() and lz_fingerprint.as_hex(f),
                                                         lz_fingerprint.as_hex(g))
        assert r.near_edited == lz_fingerprint.likeness(f, g)
        assert r.near_next == lz_fingerprint.likeness(f, h)
        better += r.near_edited > r.near_next
    assert better > 0.95 * len(docs)


def test_op6_base_spans(spark, docs):
    rules = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                                   re.ASCII), lambda m: len(m[2]) >= 8),
             ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
             ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32)]
    got = {r.doc_id: r for r in run(spark, "op6_secret_ownership")}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        spans = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(rules)
                 for m in p.finditer(d["text"] or "") if ok(m)]
        want = [f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)]
        r = got[d["doc_id"]]
        n = Counter(k for _, _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        all_ = r.spans.split(",") if r.spans else []
        assert [x for x in all_ if not x.startswith("owned")] == want
        some += bool(want)
    assert some


def test_op7_mix(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op7_mix_sources")}
    size, total = {}, Counter()
    for d in docs:
        size[d["doc_id"]] = len(WORD.findall(d["text"] or ""))
        total[d["source"]] += size[d["doc_id"]]
    names = sorted(total)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * total[s] if s in capped else rest * weight[s] / free for s in names}
        more = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not more:
            break
        capped |= more
    taken = Counter()
    for d in docs:
        r = got[d["doc_id"]]
        assert (r.size, r.source_size) == (size[d["doc_id"]], total[d["source"]])
        assert r.target == pytest.approx(target[d["source"]], rel=1e-12)
        assert r.taken in {r.size * k for k in range(4)}
        taken[d["source"]] += r.taken
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.15)
    again = {r.doc_id: r.taken for r in run(spark, "op7_mix_sources")}
    assert again == {i: r.taken for i, r in got.items()}


def test_op8_base_and_lattice(spark, docs):
    import public_tokenizers

    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    words = {d["doc_id"]: WORD.findall(lower(d["text"])) for d in docs}
    c, n_docs = Counter(), 0
    for i, w in words.items():
        if not held(i):
            c.update(w)
            n_docs += 1
    total, v = sum(c.values()) + n_docs, len(c) + 1
    den = math.log10(total + v + 1)
    got = run(spark, "op8_lattice_lm")
    assert len(got) == len(docs)
    for r in got:
        w = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(w) + 1, total)
        assert r.n_known == sum(c[x] > 0 for x in w) + 1
        base = sum(math.log10(c[x] + 1) for x in w) + math.log10(n_docs + 1) - (len(w) + 1) * den
        assert r.base_score == pytest.approx(base, rel=1e-9)
    # the same weights by brute force over a few documents
    frame = spark.createDataFrame([(k, n) for k, n in c.items()], "word string, c long")
    vocabulary = lattice_lm.load_vocabulary(public_tokenizers.path(lattice_lm.VOCABULARY))
    lattice = lattice_lm.Lattice(lattice_lm.fit_pieces(frame, vocabulary))
    ends, runs = n_docs + 1.0, sum(c.values()) + 1.0
    distinct, seen = len(c), sum(c.values())

    def word(x):
        return math.log10((c[x] + distinct * math.exp(lattice.log_prob(x))) / (seen + distinct))
    for r in got[::50]:
        want = sum(map(word, words[r.doc_id])) \
            + len(words[r.doc_id]) * math.log10(runs / (ends + runs)) + math.log10(ends / (ends + runs))
        assert r.score == pytest.approx(want, rel=1e-8)
    kept = [r for r in got if r.held_out]
    print("held out:", len(kept), sum(r.n_tokens for r in kept), sum(r.score for r in kept),
          sum(r.base_score for r in kept), sum(r.score > r.base_score for r in kept))


def test_op9_pages(spark):
    pages = table("pages")
    top = {}
    for p in pages:
        key = p["html"] or ""
        top[key] = max(top.get(key, -1), p["page_id"])
    got = {r.page_id: r for r in run(spark, "op9_warc_bundles")}
    assert len(got) == len(pages)
    for p in pages:
        raw = (p["html"] or "").encode()
        r, main = got[p["page_id"]], top[p["html"] or ""]
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if main == p["page_id"]
                                                else ("revisit", main))


def test_op10_recall_and_measure(spark):
    sf = "/root/testdata/sf0.1"
    rows = table("embeddings", sf)
    x = np.array([r["embedding"] for r in rows], np.float64)
    ids = np.array([r["vec_id"] for r in rows])
    got = defaultdict(list)
    for r in run(spark, "op10_prefix_forest", sf):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        true = set(ids[np.lexsort((ids, d))[:10]].tolist())
        own = sorted(got[int(ids[i])])
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, v) for _, v, s in own] == sorted((s, v) for _, v, s in own)
        for _, v, s in own:
            assert s == pytest.approx(d[np.flatnonzero(ids == v)[0]], rel=1e-12)
        hit += len(true & {v for _, v, _ in own})
        total += 10
    assert hit >= 0.9 * total
    assert ann.TREES > 1


def naive_spans(text, several=2, words=20):
    """(first, end, key) of the spans, and the words of each sentence."""
    ends = [m.end() for m in re.finditer(r"(?<=[.!?])[\x20\x09-\x0D]+|[\n\r]+[\x20\x09-\x0D]*", text)]
    at = [0, *ends] + ([len(text)] if not ends or ends[-1] < len(text) else [])
    own = [tuple(WORD.findall(lower(text[a:b]))) for a, b in zip(at, at[1:])]
    full = [i for i, w in enumerate(own) if w]
    out = set()
    for i in range(len(full)):
        for step in (1, -1):
            run, n = [], 0
            for k in range(i, len(full) if step == 1 else -1, step):
                run.append(k)
                n += len(own[full[k]])
                if n >= words and (len(run) == 1 or len(run) >= several):
                    out.add((min(run), max(run)))
                    if len(run) >= several:
                        break
    return [(full[a], full[b] + 1, tuple(own[k] for k in full[a:b + 1])) for a, b in out], own


def test_op3_matches_brute_force_and_removes_repeated_windows(spark, docs):
    text = {d["doc_id"]: d["text"] or "" for d in docs}
    assert len(text) == len(docs)
    spans, own = {}, {}
    for i in text:
        spans[i], own[i] = naive_spans(text[i])
    first = {}
    for i in sorted(text):
        for a, _, key in sorted(spans[i]):
            first.setdefault(key, (i, a))
    got = {r.doc_id: r for r in run(spark, "op3_sentence_spans")}
    seen, repeated, left = {}, 0, 0      # windows of 50 words that an earlier document has
    for i in sorted(text):
        gone = set()
        for a, b, key in spans[i]:
            if first[key] != (i, a):
                gone |= set(range(a, b))
        assert (got[i].n_sentences, got[i].n_removed) == (len(own[i]), len(gone))
        assert got[i].words_removed == sum(len(own[i][k]) for k in gone)
        flat = [(w, k) for k, ws in enumerate(own[i]) for w in ws]
        again = [False] * len(flat)
        for a in range(len(flat) - 49):
            window = hash(tuple(w for w, _ in flat[a:a + 50]))
            if seen.setdefault(window, i) != i:
                again[a:a + 50] = [True] * 50
        repeated += sum(again)
        left += sum(x and k not in gone for x, (_, k) in zip(again, flat))
    assert repeated and left < 0.1 * repeated
