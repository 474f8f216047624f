import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ctw


def model(texts, depth):
    """Counts of every context and node, and recursive probabilities."""
    counts = {}
    for t in texts:
        s = bytes([0xFF]) * depth + t + b"\xff"
        for i in range(depth, len(s)):
            node = 1
            for k in range(8):
                bit = s[i] >> (7 - k) & 1
                for d in range(depth + 1):
                    counts.setdefault((s[i - d : i], node), [0, 0])[bit] += 1
                node = 2 * node + bit
    children = {}
    for c, n in counts:
        if c:
            children.setdefault((c[1:], n), []).append((c, n))
    memo = {}

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weight(key):
        if key not in memo:
            own = log_kt(*counts[key])
            if len(key[0]) == depth:
                memo[key] = (own, 1.0)
            else:
                below = sum(weight(c)[0] for c in children[key])
                both = max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)
                memo[key] = (both, math.exp(own - math.log(2) - both))
        return memo[key]

    def one(history, node, d=0):
        key = (history[len(history) - d :], node)
        if key not in counts:
            return None
        a, b = counts[key]
        own = (b + 0.5) / (a + b + 1)
        deeper = one(history, node, d + 1) if d < depth else None
        if deeper is None:
            return own
        w = weight(key)[1]
        return w * own + (1 - w) * deeper

    def score(t):
        s, total = bytes([0xFF]) * depth + t + b"\xff", 0.0
        for i in range(depth, len(s)):
            node = 1
            for k in range(8):
                bit = s[i] >> (7 - k) & 1
                p = one(s[i - depth : i], node)
                p = 0.5 if p is None else p
                total += math.log10(p if bit else 1 - p)
                node = 2 * node + bit
        return total

    return score


def brute(rows, depth=ctw.DEPTH):
    low = [(d, (t or "").encode().lower(), zlib.crc32(str("" if d is None else d).encode()) % 7 == 2) for d, t in rows]
    train = [t for _, t, held in low if not held]
    words = Counter(w for t in train for w in t.split())
    n, v, ends = sum(words.values()) + len(train), len(words) + bool(train), len(train)
    score = model(train, depth)
    out = []
    for d, t, held in low:
        c = [words[w] for w in t.split()] + [ends]
        out.append((d, held, len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c), score(t)))
    return out


def check(found, want):
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect()), key=str)
    want = sorted(want, key=str)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in want])
    assert [f[6] for f in found] == pytest.approx([w[6] for w in want])


def test_against_recursion(spark, odd, none, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["the cat sat", "The dog sat on the mat", "", None, "été à Paris", "the cat", "zzz qqq", "a\tb  c\n", "mat", "the the the", "cat dog", "é", "seen once", "and again the dog"])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, bucket string, train int")
    check(ctw.score_documents(df), brute(rows))
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 20)
    monkeypatch.setattr(ctw, "PART_GRAMS", 30)
    monkeypatch.setattr(ctw, "BATCH_BYTES", 8)
    monkeypatch.setattr(ctw, "RUN_GRAMS", 10)
    check(ctw.score_documents(df.union(df)), brute(rows + rows))
    monkeypatch.setattr(ctw, "TOP_ROWS", 0)  # only contexts of one byte are broadcast
    check(ctw.score_documents(df), brute(rows))
    assert ctw.score_documents(none).count() == 0
    assert ctw.score_documents(df.where("doc_id < 0")).count() == 0


def test_odd_rows(odd):
    check(ctw.score_documents(odd.where("length(text) < 1000 or text is null")), brute([(r.doc_id, r.text) for r in odd.collect() if len(r.text or "") < 1000]))


def test_windows_cut_nothing(monkeypatch):
    texts = [b"", b"abracadabra", b"x", b"two words and more", b""]
    whole, sizes = ctw.gram_codes(texts)
    assert sizes.tolist() == [len(t) + 1 for t in texts] and len(whole) == sizes.sum()
    for size in (1, 3, 7, 16):
        monkeypatch.setattr(ctw, "BATCH_BYTES", size)
        parts = list(ctw._windows(texts, ctw.DEPTH))
        assert np.concatenate([c for c, _ in parts]).tolist() == whole.tolist()
        assert np.bincount(np.concatenate([t for _, t in parts]), minlength=5).tolist() == sizes.tolist()
        assert [w for part in ctw._words(b"  two words\tand more ") for w in part] == [b"two", b"words", b"and", b"more"]


def test_probabilities_of_a_byte_sum_to_one():
    texts = [b"abracadabra", b"banana bandana", b"cab"]
    codes, _ = ctw.gram_codes(texts)
    seen, n = np.unique(codes, return_counts=True)
    context = sum(c << (8 * k) for k, c in enumerate(reversed(b"banan")))
    grams = np.unique(np.concatenate([seen, (context << 8) + np.arange(256)]))
    counts = np.zeros(len(grams))
    counts[np.searchsorted(grams, seen)] = n
    tree = ctw.Levels(grams, counts, ctw.DEPTH, ctw.TOP + 1)
    logs = ctw.log10_bytes(grams, tree.predictions(ctw.top_levels(tree.up, ctw.TOP)))
    mine = np.searchsorted(grams, (context << 8) + np.arange(256))
    assert (10.0 ** logs[mine]).sum() == pytest.approx(1)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 8.9, 9, 100.5, 1e6, 1e12])
    assert ctw.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)
