import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import topk


def brute(rows, k, every=5):
    ok = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out, fits = [], lambda s: min(max(s, -(2**63)), 2**63 - 1)
    ok = [(i, [fits(c) for c in v]) for i, v in ok]
    for qi in sorted({i for i, _ in ok if i % every == 0}):
        q = min(v for i, v in ok if i == qi)
        others = list(ok)
        others.remove((qi, q))
        if others:
            s = sorted((-fits(sum(a * b for a, b in zip(q, v))), i) for i, v in others)[:k]
            out += [(qi, r + 1, i, -d) for r, (d, i) in enumerate(s)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(topk.top_k(df, F.col("id") % 5 == 0)) == brute(rows, 5)


def test_ties_nulls_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(700)]
    rows += [(700 + i, rows[i % 3][1]) for i in range(300)] + [(1000, None), (1001, [1.0, None]), (1005, [float("nan")]), (1010, [float("inf")]), (1015, []), (1020, [0.5])]
    monkeypatch.setattr(topk, "CANDIDATES", 150)
    monkeypatch.setattr(topk, "LEAST", 100)
    monkeypatch.setattr(topk, "STEP", 16)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, q string, id int")
    assert got(topk.top_k(df, F.col("id") % 5 == 0)) == brute(rows, 5)
    repeated = df.union(df.where("vec_id < 50"))
    assert got(topk.top_k(repeated, F.col("id") % 5 == 0)) == brute(rows + rows[:50], 5)
    few = df.where("vec_id < 3")
    assert got(topk.top_k(few, F.col("id") % 5 == 0)) == brute(rows[:3], 5)
    assert topk.top_k(df.where("1 = 0"), F.col("id") % 5 == 0).count() == 0


def test_rows_that_share_an_id_are_candidates(spark):
    rows = [(5, [2.0]), (5, [9.0]), (5, [2.0]), (6, [-1.0]), (10, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = got(topk.top_k(df, F.col("id") % 5 == 0))
    assert found == brute(rows, 5) and found[0] == (5, 1, 5, 512 * 2304)


def test_large_components(spark):
    rows = [(0, [1e17, 1.0]), (1, [1e17, -3.0]), (2, [-1e17, 2.0]), (3, [1e300, 0.0]), (4, [2.0, 2.0]), (5, [-1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(topk.top_k(df, F.col("id") % 5 == 0)) == brute(rows, 5)


def test_clusters_are_eliminated(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16)) * 4
    rows = [(i, (centres[i % 20] + rng.normal(size=16) * 0.05).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(topk.top_k(df, F.col("id") % 200 == 0)) == brute(rows, 5, 200)
    seen = topk.block_bests(df, F.col("id") % 200 == 0).groupBy("query_id").agg(F.sum("evaluated").alias("n"), F.count("*").alias("c")).collect()
    assert len(seen) == 20 and sum(r.n / 5 for r in seen) < 0.5 * 20 * 4000
