import hashlib
import math

import numpy as np

from tidemark.llm import centroids as ce


def fits(x):
    return min(max(x, -(2**63)), 2**63 - 1)


def brute(rows, width=64, k=8, rounds=10, scale=1024):
    kept = [(i, [fits(math.floor(scale * c)) for c in v]) for i, v in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    name = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else name(r[0]), r[1]))
    centres = [list(q) for _, q in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [min(range(len(centres)), key=lambda c: (far(q, centres[c]), c)) for _, q in kept]
    for _ in range(rounds):
        of = near()
        for c in range(len(centres)):
            mine = [q for (_, q), o in zip(kept, of) if o == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    of = near()
    d = [far(q, centres[c]) for (_, q), c in zip(kept, of)]
    told = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, fits(x), fits(sum(y for y, o in zip(d, of) if o == c)), fits(sum(d)), told[c]) for (i, _), c, x in zip(kept, of, d)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


KIND = "vec_id long, embedding array<double>, q string, cluster string, low int"


def test_nulls_ties_repeats_and_lengths(spark, monkeypatch):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(ce, "BLOCK", 40)
    rows = [(i, (rng.integers(-2, 3, 20) / 1024).tolist()) for i in range(400)]
    rows += rows[:30] + [(3, rows[9][1]), (None, rows[1][1]), (500, None), (501, [None] * 20), (502, [0.0]), (503, []), (504, [float("nan")] * 20), (505, [float("inf")] * 20), (506, [0.0] * 21)]
    df = spark.createDataFrame([(*r, "clash", "x", 1) for r in rows], KIND)
    assert got(ce.clusters(df, width=20)) == brute(rows, 20)
    assert got(ce.clusters(df.where("vec_id < 4"), width=20)) == brute([r for r in rows if r[0] is not None and r[0] < 4], 20)
    assert got(ce.clusters(df, width=77)) == []
    same = [(i, [0.5] * 20) for i in range(50)]
    assert got(ce.clusters(spark.createDataFrame([(*r, "clash", "x", 1) for r in same], KIND), width=20)) == brute(same, 20)


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [1e300, 2.0]), (2, [-1e300, 2.0]), (3, [1e17, -1e16]), (4, [3.0, 1.0]), (5, [4.0, 1.0])]
    df = spark.createDataFrame([(*r, "clash", "x", 1) for r in rows], KIND)
    assert got(ce.clusters(df, width=2, centroids=3)) == brute(rows, 2, 3)


def test_zones_leave_few_candidates():
    rng = np.random.default_rng(7)
    centres = (rng.normal(size=(8, 64)) * 4000).astype(np.int64)
    compared = 0
    for k in range(8):
        x = centres[k] + rng.integers(-800, 800, (500, 64))
        number, d, n = ce.assigned(x, x.min(0), x.max(0), centres)
        all_ = ((x[:, None] - centres[None]) ** 2).sum(2)
        assert (number == all_.argmin(1)).all() and (d == all_.min(1)).all()
        compared += n
    assert compared < 0.5 * 8 * 8 * 500


def test_hilbert_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij")).reshape(n, -1).T
        keys = ce.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        along = cells[np.argsort(keys)]
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_clusters_of_blocks_are_pruned(spark, monkeypatch):
    monkeypatch.setattr(ce, "BLOCK", 100)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(8, 64)) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=64)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(ce.clusters(df, rounds=2)) == brute(rows, rounds=2)
    q = df.select("vec_id", ce.integer_vectors(df, 1024, "embedding").alias("q")).toDF("id", "q")
    middle = np.floor(1024 * centres).astype(np.int64)
    compared = ce._totals(ce.zone_maps(q, 4000), middle).where("k = 0").agg({"compared": "sum"}).first()[0]
    assert compared < 0.6 * 8 * 4000
