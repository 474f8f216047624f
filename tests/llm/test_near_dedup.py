import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import near_dedup
from tidemark.llm.components import connected_components


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    fps = [(d, plain(t)) for d, t in rows]
    edges = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i][1] ^ fps[j][1]).count("1") <= 2]
    group = components(range(len(fps)), edges)
    least = {}
    for i, g in group.items():
        least[g] = min(least.get(g, fps[i][0]), fps[i][0])
    return sorted((d, f, least[group[i]]) for i, (d, f) in enumerate(fps))


def got(df):
    return sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect())


def test_odd_rows(odd, none):
    assert got(near_dedup.near_duplicates(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert near_dedup.near_duplicates(none).count() == 0


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(near_dedup.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_links_connect_what_is_within_two_bits(spark):
    import random

    rng = random.Random(3)
    fps = [0, 1, 3, 7, (1 << 64) - 1, 1 << 63, (1 << 63) | 3]
    for _ in range(60):
        base = rng.getrandbits(64)
        fps += [base] + [base ^ sum(1 << k for k in rng.sample(range(64), n)) for n in (1, 2, 2, 3, 4)]
    fps = sorted(set(fps))
    signed = {f if f < 1 << 63 else f - (1 << 64): f for f in fps}
    ab = near_dedup.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
    edges = [(signed[r.a], signed[r.b]) for r in ab.collect()]
    assert all(bin(a ^ b).count("1") <= 2 for a, b in edges)
    want = [(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 2]
    assert components(fps, edges) == components(fps, want)


def test_cells_and_points_are_never_broadcast(spark, monkeypatch):
    """Spark sizes them by the fingerprints, 33 and 65 times too low."""
    seen, keep = [], near_dedup.keep
    monkeypatch.setattr(near_dedup, "keep", lambda df, name: seen.append(df) or keep(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        seen.append(near_dedup.links(spark.range(100).select(F.col("id").alias("fp"))))
        for df in seen:
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_representatives(odd, none):
    kept = near_dedup.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8, 9, 10]
    assert near_dedup.representatives(none).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "u long, v long")
    found = {r.node: r.component for r in connected_components(chain).collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="aB \né ", max_size=40))
def test_fingerprint(text):
    assert near_dedup.simhash(text.encode().lower().split()) == plain(text)
