import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from test_near_dedup import components, plain

import corpus_pipeline
from tidemark.llm import near_dedup, similar
from tidemark.llm.common import BROADCAST_ROWS, majority, small


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a == b or len(a & b) * 5 >= 4 * len(a | b)]
    group = components(range(len(rows)), edges)
    least = {}
    for i, g in group.items():
        least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return sorted((d, least[group[i]]) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((r.doc_id, r.component_id) for r in df.collect())


def variants(seed=1):
    """Chains of edits, a widely copied text with edits, and a passage that unlike texts share."""
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    out = []
    chain = words(100)
    for _ in range(12):
        out.append(list(chain))
        chain[rng.randrange(100)] = f"e{rng.random()}"
    base = words(90)
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(90)] = f"e{rng.random()}"
        out.append(copy[rng.randrange(6) :])
    passage = words(30)
    out += [words(rng.randrange(2, 60)) + passage for _ in range(60)] + [words(40) for _ in range(30)]
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("rounds", [0, 3])
def test_groups_against_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(similar, "ROUNDS", rounds)
    rows = variants()
    assert got(similar.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_documents_and_odd_rows(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(similar.similar_groups(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(similar.similar_groups(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert similar.similar_groups(none).count() == 0


def test_edited_copies_leave_the_stage(spark):
    text = " ".join(f"word{i}" for i in range(120))
    rows = [(1, text), (2, text.replace("word40 ", "other ").replace("word80 ", "another ")), (3, "quite another text of a few words")]
    assert bin(plain(rows[0][1]) ^ plain(rows[1][1])).count("1") > 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]
    assert near_dedup.representatives(docs).count() == 3
    assert near_dedup.representatives(docs, similarity=Fraction(99, 100)).count() == 3


def edits(texts, words, changed, seed):
    """Texts of so many words that differ from one text in so many places each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    rows = []
    for i in range(texts):
        copy = list(base)
        for k in rng.sample(range(5, words - 5), changed):
            copy[k] = f"e{rng.random()}"
        rows.append((i, " ".join(copy)))
    return rows


def joined(spark, rows):
    return similar._Join(spark.createDataFrame(rows, "id long, t string"), 5, Fraction(4, 5))


def test_texts_below_the_similarity_are_told_apart_without_their_sets(spark):
    rows = edits(30, 400, 8, 3)
    assert len({g for _, g in brute(rows)}) == 30
    join = joined(spark, rows)
    ids = join.texts.select("cls")
    assert join.close(ids.select(F.col("cls").alias("a")).crossJoin(ids.select(F.col("cls").alias("b")))).count() == 0
    # what is similar stays
    rows = edits(12, 400, 3, 4)
    join = joined(spark, rows)
    ids = join.texts.select("cls")
    assert {g for _, g in brute(rows)} == {0}
    assert join.close(ids.select(F.col("cls").alias("a")).crossJoin(ids.select(F.col("cls").alias("b")))).count() == 66


def test_fingerprints_link_before_the_join(spark):
    rows = edits(8, 1500, 1, 5) + [(100 + i, t) for i, t in edits(8, 60, 2, 6)]
    fps = {i: majority(similar.shingle_hashes(t.encode().split(), 5)) for i, t in rows}
    near = [(i, j) for i, a in fps.items() for j, b in fps.items() if j < i and (a ^ b).bit_count() <= 2]
    assert near
    join = joined(spark, rows)
    name = {r.cls: r.first for r in join.texts.collect()}
    marks = [(name[r[0]], name[r[1]]) for r in join.marks().collect()]
    assert components(fps, marks) == components(fps, near)
    join.link(join.marks(), True)
    found = {(name[r.a], name[r.b]) for r in join.links.collect()}
    assert found and all(len(shingles(dict(rows)[a]) & shingles(dict(rows)[b])) * 5 >= 4 * len(shingles(dict(rows)[a]) | shingles(dict(rows)[b])) for a, b in found)


def test_words_of_a_text_are_let_go_before_the_next():
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(2000)) for _ in range(250)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(250), pa.int64()), pa.array(texts)], names=["id", "t"])
    context = SimpleNamespace(broadcast=lambda v: SimpleNamespace(value=v))
    rows = SimpleNamespace(mapInArrow=lambda run, schema: run, sparkSession=SimpleNamespace(sparkContext=context))
    for run in (similar._marked(rows, 5), similar._sets(rows, 5)):
        list(run(iter([batch.slice(0, 1)])))
        tracemalloc.start()
        found = list(run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # 3.4 MB of texts: their words alone are over 25 MB
        assert sum(b.num_rows for b in found) == 250 and peak < 16 << 20
    sets = [shingles(t) for t in texts]
    assert np.concatenate([b.column(1).to_numpy() for b in found]).tolist() == [len(s) for s in sets]


def test_later_links_meet_by_names_of_components_alone(spark, monkeypatch):
    join, seen, links = joined(spark, edits(3, 60, 2, 8)), [], similar.connected_components

    def counted(edges, made):
        seen.append(edges.where("u <> v").count())
        return links(edges, made)

    monkeypatch.setattr(similar, "connected_components", counted)
    rng = random.Random(9)
    steps = [[(i, i + 1) for i in range(40) if i % 10], [(rng.randrange(60), rng.randrange(60)) for _ in range(8)], [(3, 4), (7, 5)], [(70, 71), (-5, 70), (71, 12)]]
    for k, step in enumerate(steps):
        join.add(spark.createDataFrame(step, "a long, b long"))
        every = [e for s in steps[: k + 1] for e in s]
        nodes = {n for e in every for n in e}
        group = components(nodes, every)
        least = {}
        for n, g in group.items():
            least[g] = min(n, least.get(g, n))
        assert {n: n for n in nodes} | {r.cls: r.root for r in join.roots.collect()} == {n: least[g] for n, g in group.items()}
    assert (seen[0], seen[2], seen[3]) == (36, 0, 3)


def test_prefixes_are_dealt_by_their_number(spark, monkeypatch):
    rows = variants()
    join = joined(spark, rows)
    sets = {r.cls: r.n for r in join.marked.join(join.texts, "cls").select("cls", "n").collect()}
    assert join.places >= sum(n - -(-n * 4 // 5) + 1 for n in sets.values())
    monkeypatch.setattr(similar, "KEYS_A_TASK", 500)
    parts = []
    monkeypatch.setattr(join, "keep", lambda df, name: parts.append(df.rdd.getNumPartitions()) or df)
    assert sorted(map(tuple, join.keys().collect())) == sorted(map(tuple, joined(spark, rows).keys().collect()))
    assert parts == [-(-join.places // 500)] and parts[0] > 4


def test_links_of_all_kinds_take_few_plans(spark, monkeypatch):
    rows = edits(8, 1500, 1, 5) + [(100 + i, t) for i, t in variants()]
    plans, links, write = [], similar.connected_components, near_dedup.keep
    monkeypatch.setattr(similar, "connected_components", lambda *a: plans.append("components") or links(*a))
    monkeypatch.setattr("tidemark.llm.common.keep", lambda df, name, *a: plans.append(name) or write(df, name, *a))
    assert got(similar.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    # links of fingerprints and those with a hub are decided and connected together, then the pairs of shingles in ROUNDS + 1 steps
    assert plans.count("components") <= 2 + similar.ROUNDS and "wanted" not in plans


def test_common_shingles_do_not_come_to_the_driver_as_rows(spark, monkeypatch):
    rows = variants()
    monkeypatch.setattr(similar, "COMMON", 40)
    join, told, sets = joined(spark, rows), [], similar._sets
    monkeypatch.setattr(similar, "_sets", lambda *a: told.extend(a[4:]) or sets(*a))
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: pytest.fail("rows of every task through the driver"))
    join.keys()
    (common,) = told
    counts = {}
    for s in {frozenset(map(int, similar.shingle_hashes(t.encode().lower().split(), 5).view("int64"))) for _, t in rows}:
        for h in s:
            counts[h] = counts.get(h, 0) + 1
    # a task counts a text once, so a copied one may count a few times
    assert len(common) == 40 and min(counts[int(h)] for h in common) >= similar.LEAST


def test_shingles_of_many_texts_are_never_broadcast(spark, monkeypatch):
    """Their texts' vectors, sketches and lists of shingles take many times what Spark makes of the compressed table."""
    plans, link = [], similar._Join.link
    monkeypatch.setattr(similar._Join, "link", lambda self, pairs, one_each=False, near=False: plans.append((one_each, pairs._jdf.queryExecution().executedPlan().toString())) or link(self, pairs, one_each, near))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        found = joined(spark, edits(30, 400, 8, 3)).run().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len({r.component_id for r in found}) == 30
    steps = [plan for one_each, plan in plans if not one_each]
    assert len(steps) == similar.ROUNDS + 1
    assert all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for plan in steps)


def test_a_side_beyond_the_limit_is_not_broadcast_by_its_size(spark):
    few, rows = spark.range(3), spark.range(5)
    plan = lambda n: rows.join(small(few, n), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(BROADCAST_ROWS) and "BroadcastHashJoin" not in plan(BROADCAST_ROWS + 1)
