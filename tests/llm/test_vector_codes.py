import hashlib
import math

import numpy as np

from tidemark.llm import vector_codes as vc


def fits(x):
    return min(max(x, -(2**63)), 2**63 - 1)


def brute(rows, scale=4096, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, hash) by comparing everything with everything, in whole numbers."""
    kept = [(i, v, t) for i, v, t in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return []
    width = max(max(len(v) for _, v, _ in kept), 1)
    wide = -(-width // parts)
    q = [[fits(math.floor(scale * c)) for c in v] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0], q[k]))
    q = [x + [0] * (wide * parts - len(x)) for x in q]
    cut = [[x[p * wide : (p + 1) * wide] for p in range(parts)] for x in q]
    books = [[list(cut[k][p]) for k in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (far(x[p], books[p][e]), e)) for p in range(parts)] for x in cut]
    for _ in range(rounds):
        code = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p] for x, c in zip(cut, code) if c[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    code = assign()
    error = [sum(far(x[p], books[p][c[p]]) for p in range(parts)) for x, c in zip(cut, code)]
    labels = {}
    for (_, _, t), e in zip(kept, error):
        labels[t] = labels.get(t, 0) + e
    told = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{x:02x}" for x in c), fits(e), fits(labels[t]), told) for (i, _, t), c, e in zip(kept, code, error)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert got(vc.vector_codes(df)) == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])


KIND = "vec_id long, embedding array<double>, label int, q string, id int, codes string"


def test_nulls_ties_repeats_and_lengths(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-3, 4, 16) / 4096).tolist(), i % 4 or None) for i in range(300)]  # many ties
    rows += rows[:20] + [(5, rows[7][1], 1), (None, rows[3][1], None), (900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 16, 2), (903, [float("-inf")] + [0.0] * 15, 2), (904, [], 3), (905, [0.5, 0.25, -0.125], 3)]
    monkeypatch.setattr(vc, "BLOCK_BYTES", 8 * 16 * 50)
    df = spark.createDataFrame([(*r, "clash", 1, "x") for r in rows], KIND)
    assert got(vc.vector_codes(df)) == brute(rows)
    assert got(vc.vector_codes(df.where("vec_id < 5"))) == brute([r for r in rows if r[0] is not None and r[0] < 5])
    assert got(vc.vector_codes(df.where("1 = 0"))) == []
    assert got(vc.vector_codes(df, parts=3, entries=5, rounds=2)) == brute(rows, parts=3, entries=5, rounds=2)


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [1e300, 2.0] + [0.0] * 6, 1), (2, [-1e300, 2.0] + [0.0] * 6, 1), (3, [1e17, -1e16] + [1.0] * 6, None), (4, [3.0] * 8, None)]
    df = spark.createDataFrame([(*r, "clash", 1, "x") for r in rows], KIND)
    assert got(vc.vector_codes(df, entries=2)) == brute(rows, entries=2)


def test_stable_cores_and_rings_save_work(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 8)) * 20
    x = np.floor(4096 * (centres[np.arange(8000) % 16] + rng.normal(size=(8000, 8)))).astype(np.int64)
    book = np.floor(4096 * centres).astype(np.int64)
    code, best, compared = vc.nearest(x, np.arange(8000) % 16, book)
    all_ = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (code == all_.argmin(1)).all() and (best == all_.min(1)).all()
    assert compared < 0.3 * all_.size
