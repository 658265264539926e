"""op1's whole score against a plain-Python version of the model."""

import math
import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_contracts import run, table  # noqa: E402

from ledgerline.llm import toxicity as tx  # noqa: E402
from ledgerline.llm.common import Words  # noqa: E402

SF = "/root/testdata/sf0.01"


def cells(text):
    """(token cell, stem cell) of every word (the hashing is tested apart)."""
    w = Words([text], head=tx.STEM_BYTES)
    shift = 64 - tx.CELL_BITS
    return [(int(h) >> shift, int(s) >> shift) for h, s in zip(w.hashes, w.heads)]


def best_segments(s):
    """By definition: the best stretch, then left and right of it."""
    best, at, low, low_at, total = 0.0, None, 0.0, 0, 0.0
    for i, x in enumerate(s):
        total += x
        if total - low > best + 1e-12:
            best, at = total - low, (low_at, i + 1)
        if total < low - 1e-12 or total <= low:
            low, low_at = total, i + 1
    if at is None:
        return []
    a, b = at
    return best_segments(s[:a]) + [best] + best_segments(s[b:])


def test_score_matches_the_plain_model(spark):
    sys.setrecursionlimit(100_000)
    docs = {d["doc_id"]: cells(d["text"] or "") for d in table("documents", SF)}
    fold = {i: zlib.crc32(str(i).encode()) % 4 for i in docs}
    label = {r["doc_id"]: r["toxic"] for r in table("labels", SF) if r["toxic"] in (0, 1) and r["doc_id"] in docs}
    train = [i for i in label if fold[i] in (0, 1)]
    token, stem = (Counter(), Counter()), (Counter(), Counter())
    for i in train:
        token[label[i]].update({t for t, _ in docs[i]})
        stem[label[i]].update({s for _, s in docs[i]})
    n0, n1 = (sum(c.values()) for c in token)
    base = n1 / (n0 + n1)

    def score(t, s):
        prior = (stem[1][s] + tx.STEM_PRIOR * base) / (stem[0][s] + stem[1][s] + tx.STEM_PRIOR)
        share = (token[1][t] + tx.TOKEN_PRIOR * prior) / (token[0][t] + token[1][t] + tx.TOKEN_PRIOR)
        share = min(max(share, 1e-4), 1 - 1e-3)
        x = math.log(share / (1 - share)) - math.log(base / (1 - base))
        return x if x > tx.NOISE else min(x, tx.STEP)
    known = {}
    found = {}
    for i, words in docs.items():
        found[i] = best_segments([known.setdefault(w, score(*w)) for w in words])
    held = [i for i in label if fold[i] == 3]
    clean = sorted(max(found[i]) - math.log(len(docs[i])) for i in held if label[i] == 0 and found[i])
    q50, q90 = (clean[math.ceil(p * len(clean)) - 1] for p in (0.5, 0.9))
    rate = (2.2503673 - 0.3665129) / (q90 - q50)
    place = rate * q50 - 0.3665129

    def evidence(i):
        if not found[i]:
            return tx.FLOOR
        x = sorted((rate * (v - math.log(max(len(docs[i]), 1))) - place for v in found[i]), reverse=True)
        strong = [v for v in x if v > 0]
        if not strong:
            return max(tx.FLOOR, x[0])
        sums = [sum(strong[:r]) - math.lgamma(r + 1) for r in range(1, len(strong) + 1)]
        return min(tx.CEIL, max(*sums, x[0]))
    ev = {i: evidence(i) for i in docs}
    # the curve: the same loss, minimised by plain gradient steps from Newton's start
    pts = [(min(max(round(ev[i] / tx.BIN) * tx.BIN, tx.CURVE[0]), tx.CURVE[1]), label[i]) for i in held]
    m1 = sum(y for _, y in pts)
    m0 = len(pts) - m1
    goal = {1: (m1 + 1) / (m1 + 2), 0: 1 / (m0 + 2)}

    def loss(a, b):
        out = 0.5e-3 * a * a
        for x, y in pts:
            z = a * x + b
            out += math.log1p(math.exp(-abs(z))) + max(z, 0) - goal[y] * z
        return out
    got = run(spark, "op1_toxicity", SF)
    assert len(got) == len(docs)
    curve = {}
    for r in got:
        assert r.evidence == pytest.approx(ev[r.doc_id], rel=1e-3, abs=1e-3)
        assert r.held_out == (fold[r.doc_id] == 2) and r.predicted == int(r.score >= 0.3)
        curve[min(max(r.evidence, tx.CURVE[0]), tx.CURVE[1])] = r.score
    # the scores lie on one logistic curve ...
    (x1, p1), (x2, p2) = min(curve.items()), max(curve.items())
    logit = lambda p: math.log(p / (1 - p))
    a = (logit(p2) - logit(p1)) / (x2 - x1)
    b = logit(p1) - a * x1
    assert all(p == pytest.approx(1 / (1 + math.exp(-a * x - b)), abs=1e-9) for x, p in curve.items())
    # ... which no nearby curve betters on the held texts
    here = loss(a, b)
    for da, db in ((1e-3, 0), (-1e-3, 0), (0, 1e-2), (0, -1e-2), (1e-3, -1e-2), (-1e-3, 1e-2)):
        assert loss(a + da, b + db) >= here - 1e-6
    assert np.isfinite(list(curve.values())).all()
