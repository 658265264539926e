"""run() against the stages' plain-Python versions, row by row."""

import itertools
import os
import struct
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_cases import redacted, secret_spans  # noqa: E402
from test_contracts import WORD, lower  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerline.llm import mixing, toxicity  # noqa: E402
from ledgerline.llm.common import read  # noqa: E402

SF = "/root/testdata/sf0.01"


def near_duplicates_kept(docs):
    """Of each group of (id, text) the row with the smallest id."""
    sets = []
    for _, t, _ in docs:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(len(docs)), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return [d for k, d in enumerate(docs) if find(k) == k]


def copies(docs):
    """How often the mix takes each of (id, text, source)."""
    total = Counter()
    for _, t, s in docs:
        total[s] += len(WORD.findall(t or ""))
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped = set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        target = {s: 3 * total[s] if s in capped else rest * weight[s] / free for s in names}
        more = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not more or more | capped == set(names):
            break
        capped |= more
    out = []
    for i, t, s in docs:
        h = 42
        for raw in (struct.pack("<i", mixing.SEED), None if i is None else struct.pack("<q", i),
                    None if s is None else s.encode(), None if t is None else t.encode()):
            if raw is not None:
                h = xxhash.xxh64_intdigest(raw, h)
        rate = target[s] / total[s] if total[s] else 0.0
        out.append(int(rate) + ((h >> 11) / float(1 << 53) < rate - int(rate)))
    return out


def check_packed(rows, docs):
    """Every token of every copy once, in order, sequences without gaps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {(i, t): tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _ in docs}
    want = Counter()
    for (i, t, _), n in docs.items():
        for k, x in enumerate(ids[i, t]):
            want[i, k, x] += n
    got, places = Counter(), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids)
        for k, x in enumerate(r.ids):
            got[r.doc_id, r.start + k, x] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for seq, own in places.items():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at == 2048 or seq == max(places)


def test_run_matches_the_chained_plain_versions(spark):
    docs = sorted((r.doc_id, r.text, r.source) for r in read(spark, SF, "documents").collect())
    toxic = {r.doc_id for r in toxicity.score(read(spark, SF, "documents"), read(spark, SF, "labels"))
             .where("predicted = 1").collect()}
    docs = near_duplicates_kept([d for d in docs if d[0] not in toxic])
    docs = [(i, redacted(t, s), src) for (i, t, src), s in zip(docs, secret_spans(docs))]
    mixed = Counter()
    for d, n in zip(docs, copies(docs)):
        if n:
            mixed[d] += n
    assert any("[SECRET]" in d[1] for d in mixed) and max(mixed.values()) > 1
    check_packed(corpus_pipeline.run(spark, SF).collect(), mixed)


ROWS = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (4, "one two", "b"), (4, "other text", "b"),
        (None, "alpha beta gamma delta epsilon zeta", "b"), (5, "alpha beta gamma delta epsilon zeta", None),
        (6, "ALPHA beta gamma delta epsilon zeta", "c"), (7, "é" * 50 + " password = 'abcdefgh1234'", "c")]


@pytest.mark.parametrize("rows", [[], ROWS])
def test_run_on_empty_and_odd_tables(spark, scratch, rows):
    root = scratch("odd-corpus")
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, None, 1)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{root}/labels.parquet")
    got = corpus_pipeline.run(spark, root).collect()
    if not rows:
        assert got == []
        return
    # near duplicates: by id and text, 6 is a copy of 5; a null id is nobody's copy
    kept = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (4, "other text", "b"),
            (5, ROWS[7][1], None), (7, ROWS[9][1], "c"), (None, ROWS[6][1], "b")]
    kept = [(i, redacted(t, s) if t else t, src) for (i, t, src), s in zip(kept, secret_spans(kept))]
    mixed = Counter({d: n for d, n in zip(kept, copies(kept)) if n})
    check_packed(got, mixed)
    assert np.sum([n for n in mixed.values()]) == sum(r.start == 0 for r in got)
