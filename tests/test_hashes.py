"""Canonical text, hashes, comparison and Merkle trees against hashlib and json."""

import hashlib
import json
import random
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import canonical
from tidemark.operators import compare, merkle, profile


def dumps(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


RECORDS = [
    {"b": "2", "a": "1"}, {"é": "\x7f\x00\x1f", "k": None}, {"q": 'say "\\u00AB" \\\\u00ab', "\U0001f600": " «퟿"}, {}, {"": ""}, {"x": "\\\\\\é", "/": "</script>\t\r\n\b\f"},
]


def test_canonical_text_equals_json(spark):
    rng = random.Random(1)
    alphabet = ["a", "B", "\\", '"', "é", "«", "\x7f", "\x01", "/", "u", "0", "A", "\U0001f600", "\n", "中"]
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randrange(9)))
    maps = RECORDS + [{word(): rng.choice([None, word()]) for _ in range(rng.randrange(5))} for _ in range(400)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, rec map<string,string>")
    for r in df.select("i", canonical.canonical_text("rec").alias("c"), canonical.record_hash("rec").alias("h")).collect():
        want = dumps(maps[r.i])
        assert r.c == want
        assert r.h == hashlib.sha256(want.encode()).hexdigest()


def test_known_hash(spark):
    rows = spark.createDataFrame([("1", {"b": "2", "a": "1"})], "object_id string, rec map<string,string>").selectExpr("object_id", "rec", "'d' as day")
    found = canonical.table_hash(rows, "object_id", "rec", ["day"]).first()
    text = b'[{"a":"1","b":"2"}]'
    assert (found.objects, found.raw_bytes, found.sha256) == (1, len(text), hashlib.sha256(text).hexdigest())


def test_table_hash_and_stream_hash_agree(spark):
    rows = [(str(i), {"id": str(i), "v": "é" * (i % 3)}) for i in random.Random(2).sample(range(300), 200)] + [("01", {"id": "01"}), ("x", {"id": "x"})]
    df = spark.createDataFrame(rows, "object_id string, rec map<string,string>").selectExpr("*", "1 as day").repartition(5)
    number = lambda t: int(t) if t.isdigit() else 0
    text = dumps([r for _, r in sorted(rows, key=lambda x: (number(x[0]), x[0]))]).encode()
    found = canonical.table_hash(df, "object_id", "rec", ["day"]).first()
    assert (found.objects, found.raw_bytes, found.sha256) == canonical.stream_hash(df, "object_id", "rec") == (len(rows), len(text), hashlib.sha256(text).hexdigest())


def test_days_of_any_size_are_streamed(spark, monkeypatch):
    """Pieces of 200 bytes, batches of 7 rows, groups that are null, repeated ids, texts outside ASCII."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), str(rng.randrange(150)), {"id": "x", "v": rng.choice(["é\x7f", '"\\', None, "\x01"])}) for _ in range(600)] + [("long", "1", {"v": "y" * 1000})]
    df = spark.createDataFrame(rows, "day string, object_id string, rec map<string,string>").repartition(6)
    want = {}
    for d in ("a", "b", None, "long"):
        text = ("[" + ",".join(t for _, t in sorted((int(i), dumps(r)) for day, i, r in rows if day == d)) + "]").encode()
        want[d] = (sum(day == d for day, _, _ in rows), len(text), hashlib.sha256(text).hexdigest())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {r.day: (r.objects, r.raw_bytes, r.sha256) for r in canonical.table_hash(df, "object_id", "rec", ["day"]).collect()}
        pieces = canonical.text_pieces(df, "object_id", "rec", ["day"], size=200).persist()
        assert pieces.count() > 60 and pieces.where("records > 1 and length(text) > 400").count() == 0
        streamed = {r.day: (r.objects, r.raw_bytes, r.sha256) for r in canonical.piece_hash(pieces, ["day"]).collect()}
        ids = {r.day: (r.ids, r.sha256) for r in canonical.id_set_hash(df, "object_id", ["day"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == streamed == want
    for d in want:
        have = sorted({int(i) for day, i, _ in rows if day == d})
        assert ids[d] == (len(have), hashlib.sha256("\n".join(map(str, have)).encode()).hexdigest())
    assert canonical.stream_hash(df.where("1 = 0"), "object_id", "rec") == (0, 2, hashlib.sha256(b"[]").hexdigest())


def test_id_set_hash(spark):
    df = spark.createDataFrame([("10", 1), ("9", 1), ("9", 1), (None, 1), ("2", 2)], "id string, day int")
    got = {r.day: (r.ids, r.sha256) for r in canonical.id_set_hash(df, "id", ["day"]).collect()}
    assert got == {1: (2, hashlib.sha256(b"9\n10").hexdigest()), 2: (1, hashlib.sha256(b"2").hexdigest())}


def test_comparison(spark):
    kind = "object_id string, rec map<string,string>"
    left = spark.createDataFrame([("1", {"a": "1"}), ("2", {"a": "1", "b": None}), ("3", {"a": "1", "z": "2"}), ("10", {})], kind)
    right = spark.createDataFrame([("1", {"a": "1"}), ("2", {"a": "1"}), ("3", {"a": "2", "c": "3"}), ("11", {})], kind)
    aligned = compare.align(left, right)
    c = compare.compare_counts(aligned).first().asDict()
    assert c == {"left_count": 4, "right_count": 4, "shared_count": 3, "matched_count": 1, "mismatched_count": 2, "only_left_count": 1, "only_right_count": 1}
    # a missing field and a null one differ in the hash but not as fields
    assert {r.object_id: (r.differing_fields, r.differing_field_count) for r in compare.field_diff(aligned).collect()} == {"2": ([], 0), "3": (["a", "c", "z"], 3)}
    assert [r.object_id for r in compare.sample(aligned, "mismatched", 1).collect()] == ["2"]
    assert compare.field_diff(aligned, shown=1).where("object_id = '3'").first().differing_fields == ["a"]


def tree(data, size, least):
    h = lambda b: hashlib.sha256(b).digest()
    n32 = lambda n: n.to_bytes(32, "big")
    cuts, at = [], 0
    while len(data) - at >= size:
        over = len(data) - at - size
        step = (len(data) - at + 1) // 2 if 0 < over < least else size
        cuts.append((at, at + step))
        at += step
    cuts.append((at, len(data)))
    nodes = [(h(h(h(data[a:z])) + h(n32(z))), z) for a, z in cuts]
    while len(nodes) > 1:
        nodes = [(h(h(nodes[i][0]) + h(nodes[i + 1][0]) + h(n32(nodes[i][1]))), nodes[i + 1][1]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return cuts, nodes[0][0].hex()


def test_merkle(spark):
    rng = random.Random(3)
    sizes = [0, 1, 15, 16, 17, 19, 20, 21, 32, 33, 35, 36, 48, 100, 160, 163, 300]
    files = {str(n): rng.randbytes(n) for n in sizes}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "path string, content binary")
    found = merkle.chunks(df, size=16, least=4)
    got = {}
    for r in found.orderBy("pos").collect():
        got.setdefault(r.path, []).append((r.start, r.end))
    roots = {r.path: r.root for r in merkle.roots(found).collect()}
    for k, v in files.items():
        cuts, root = tree(v, 16, 4)
        assert got[k] == cuts and roots[k] == root, k
    proofs = merkle.proofs(found)
    known = merkle.roots(found)
    checked = merkle.check_proofs(proofs, known).collect()
    assert len(checked) == sum(z > a for k in files for a, z in tree(files[k], 16, 4)[0])
    assert all(r.ok for r in checked)
    spoiled = proofs.withColumn("data_hash", merkle.F.sha2("data_hash", 256))
    assert not any(r.ok for r in merkle.check_proofs(spoiled, known).collect())


def test_files_are_read_by_ranges(spark, tmp_path):
    """Runs of 50 bytes stand for files beyond 2 GB: chunks of a run follow a seek."""
    from tidemark.sources import files

    rng = random.Random(11)
    data = {f"{n}.bin": rng.randbytes(n) for n in (1, 15, 16, 19, 33, 160, 163, 1000, 5000)}
    for name, b in data.items():
        (tmp_path / name).write_bytes(b)
    listed = files.file_list(spark, str(tmp_path))
    found = files.chunk_hashes(listed, 16, 4, run_bytes=50)
    got = {}
    for r in found.collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.pos, r.start, r.end, r.data_hash))
    known = {r.path.rsplit("/", 1)[1]: r.root for r in merkle.roots(found).collect()}
    whole = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in files.file_hashes(listed).collect()}
    for name, b in data.items():
        cuts, root = tree(b, 16, 4)
        assert sorted(got[name]) == [(k, a, z, hashlib.sha256(b[a:z]).hexdigest()) for k, (a, z) in enumerate(cuts)]
        assert known[name] == root and whole[name] == (len(b), hashlib.sha256(b).hexdigest())


def _chunked(spark, data):
    return merkle.chunks(spark.createDataFrame([(k, bytearray(v)) for k, v in data.items()], "path string, content binary"), size=16, least=4)


def test_differences_of_trees(spark, monkeypatch):
    rng = random.Random(12)
    old = {"a": rng.randbytes(16 * 300 + 7), "b": rng.randbytes(40), "gone": rng.randbytes(50), "same": rng.randbytes(700), "grown": rng.randbytes(33)}
    new = dict(old) | {"new": rng.randbytes(20), "grown": old["grown"] + rng.randbytes(16 * 40)}
    del new["gone"]
    changed = bytearray(new["a"])
    changed[16 * 5] ^= 1
    changed[16 * 299] ^= 1
    new["a"] = bytes(changed)
    want = set()
    for f in {*old, *new}:
        x, y = ({k: (a, z, d[f][a:z]) for k, (a, z) in enumerate(tree(d[f], 16, 4)[0])} if f in d else {} for d in (old, new))
        for k in {*x, *y}:
            if x.get(k) != y.get(k):
                a, z, _ = y.get(k) or x[k]
                want.add((f, k, a, z, "added" if k not in x else "removed" if k not in y else "changed"))
    trees = [merkle.Tree(_chunked(spark, d)) for d in (old, new)]
    for pushed in (1000, 0):
        monkeypatch.setattr(merkle, "PUSHED", pushed)
        found, compared = merkle.differences(*trees)
        assert {tuple(r) for r in found.collect()} == want
    one = [merkle.Tree(_chunked(spark, {"a": d["a"]})) for d in (old, new)]
    found, compared = merkle.differences(*one)
    assert found.count() == 2 and compared <= 4 * len(one[0].levels) < 301
    found, compared = merkle.differences(trees[1], trees[1])
    assert found.count() == 0 and compared == len(new)


def test_one_proof_for_many_chunks(spark, monkeypatch):
    rng = random.Random(13)
    data = {"a": rng.randbytes(16 * 37 + 5), "b": rng.randbytes(10), "c": rng.randbytes(16 * 8)}
    found = _chunked(spark, data)
    known, whole = merkle.roots(found), merkle.Tree(found)
    for pushed in (1000, 0):
        monkeypatch.setattr(merkle, "PUSHED", pushed)
        chosen = found.where("end > start and (pos in (0, 1, 7, 20, 36) or path = 'b')")
        proof = merkle.joint_proof(whole, chosen)
        beside = proof.where("id is not null and path = 'a'").count()
        alone = merkle.proofs(found).where("path = 'a' and pos in (0, 1, 7, 20, 36)").agg({"proof": "count"}).first()[0]
        assert beside < sum(len(r.proof) for r in merkle.proofs(found).where("path = 'a' and pos in (0, 1, 7, 20, 36)").collect()) and alone == 5
        assert {r.path: r.ok for r in merkle.check_joint_proof(chosen, proof, known).collect()} == {"a": True, "b": True, "c": True}
    spoiled = chosen.withColumn("data_hash", merkle.F.when(merkle.F.expr("path = 'a' and pos = 20"), merkle.F.sha2("data_hash", 256)).otherwise(merkle.F.col("data_hash")))
    assert {r.path: r.ok for r in merkle.check_joint_proof(spoiled, proof, known).collect()} == {"a": False, "b": True, "c": True}


def test_profiles(spark):
    df = spark.createDataFrame([({"a": "1", "b": ""},), ({"a": "1", "b": None},), ({"a": "2"},)], "rec map<string,string>")
    got = {r.field: (r.records, r.blanks, r["distinct"], r.smallest, r.largest, r.constant) for r in profile.field_profile(df).collect()}
    assert got == {"a": (3, 0, 2, "1", "2", False), "b": (2, 2, 0, None, None, True)}
    assert {(tuple(r["keys"]), r.records) for r in profile.key_sets(df).collect()} == {(("a", "b"), 2), (("a",), 1)}
    assert [(r.field, r["rank"], r.value) for r in profile.top_values(df, 1).orderBy("field").collect()] == [("a", 1, "1"), ("b", 1, "")]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.integers(0, 200), min_size=1, max_size=30))
def test_id_gaps(spark, ids):
    r = profile.id_gaps(spark.createDataFrame([(i,) for i in ids], "i long"), "i", bucket=20).first()
    have = sorted(set(ids))
    gaps = [(b - a - 1, a + 1, b - 1) for a, b in zip(have, have[1:]) if b > a + 1]
    best = max(gaps, key=lambda g: (g[0], -g[1]), default=(0, None, None))
    assert (r.present, r.span, r.missing, r.largest_gap, r.gap_from, r.gap_to) == (len(have), have[-1] - have[0] + 1, have[-1] - have[0] + 1 - len(have), *best)


def test_attestations(spark):
    blocks = spark.createDataFrame([("c", "g", None), ("c", "a", "g"), ("c", "b", "a"), ("c", "x", "g"), ("d", "only", None)], "chain string, block string, parent string")
    attested = spark.createDataFrame([("c", "r", "b", "p", 10), ("c", "r", "x", "q", 10), ("c", "r", "a", "q", 5), ("c", "r", "g", "z", 1)], "chain string, ref string, block string, attester string, block_time int")
    scores = spark.createDataFrame([("p", 10, 3.0), ("p", 11, 99.0), ("q", 6, 2.5)], "attester string, score_time int, score double")
    scored = profile.scored_attestations(attested, scores)
    assert {(r.block, r.attester): r.score for r in scored.collect()} == {("b", "p"): 3.0, ("x", "q"): 2.5, ("a", "q"): 0.0, ("g", "z"): 0.0}
    assert {(r.chain, r.tip, r.weight, r.length) for r in profile.heaviest_branch(blocks, scored).collect()} == {("c", "b", 3.0, 3), ("d", "only", 0.0, 1)}


def test_heaviest_branch_of_a_long_chain(spark):
    import pytest

    rows = [("c", f"n{i}", f"n{i - 1}" if i else None) for i in range(1500)] + [("c", "fork", "n0")]
    scored = spark.createDataFrame([("c", f"n{i}", 1.0) for i in range(1500)] + [("c", "fork", 5.0)], "chain string, block string, score double")
    blocks = spark.createDataFrame(rows, "chain string, block string, parent string")
    assert [tuple(r) for r in profile.heaviest_branch(blocks, scored).collect()] == [("c", "n1499", 1500.0, 1500)]
    with pytest.raises(ValueError):
        profile.heaviest_branch(spark.createDataFrame([("c", "a", "b"), ("c", "b", "a")], "chain string, block string, parent string"), scored)


def test_a_tree_reads_its_chunks_once(spark, tmp_path):
    """Levels, spans and proofs come from one reading of the files; small files share a task."""
    import uuid

    from tidemark.sources import files

    (tmp_path / "texts").mkdir()
    for k in range(120):
        (tmp_path / "texts" / f"{k:03}").write_bytes(bytes([k]) * (10_000 + k))
    listed = files.file_list(spark, str(tmp_path / "texts"))
    found = files.chunk_hashes(listed, 4096, 512)
    assert found.rdd.getNumPartitions() == 3
    seen = str(tmp_path / "seen")

    def told(batches):
        import pathlib

        pathlib.Path(seen).mkdir(exist_ok=True)
        for batch in batches:
            for _ in range(batch.num_rows):
                (pathlib.Path(seen) / uuid.uuid4().hex).touch()
            yield batch

    n = found.count()
    tree = merkle.Tree(found.coalesce(1).mapInArrow(told, found.schema))
    chosen = tree.spans.where("pos = 1")
    proof = merkle.joint_proof(tree, chosen)
    checked = merkle.check_joint_proof(chosen, proof, tree.level(99).select("path", F.lower(F.hex("id")).alias("root"))).collect()
    assert len(checked) == 120 and all(r.ok for r in checked)
    assert len(list((tmp_path / "seen").iterdir())) == n


def test_heaviest_branch_by_contraction(spark, monkeypatch):
    """Caterpillars, chains, random trees, parents that are no blocks, blocks twice, ties: as walking each path gives it, and rounds get smaller."""
    rng = random.Random(9)
    rows = []
    for chain in range(6):
        for k in range(300):
            parent = [k - 1, k - 1 - (k % 3 == 0), rng.randrange(k) if k else -1, k - 1 if k % 50 else None, rng.choice([k - 1, k - 2, -7]), 0][chain]
            rows.append((chain, k, None if parent is None or (parent < 0 and parent != -7) or parent == k else parent))
    rows += rows[::7]
    scores = [(c, rng.randrange(300), float(rng.randrange(3))) for c in range(6) for _ in range(500)]
    parents, weight = {(c, b): p for c, b, p in rows}, Counter()
    for c, b, s in scores:
        weight[c, b] += s
    want = []
    for chain in range(6):
        best = None
        for tip in {b for c, b, _ in rows if c == chain} - {p for c, _, p in rows if c == chain}:
            at, w, n = tip, 0.0, 0
            while (chain, at) in parents:
                w, n, at = w + weight[chain, at], n + 1, parents[chain, at]
            best = min(best, (-w, tip, n)) if best else (-w, tip, n)
        want.append((chain, best[1], -best[0], best[2]))
    sizes, once = [], profile.contracted

    def counted(walk, number):
        out = once(walk, number)
        sizes.append((walk.count(), out.count()))
        return out

    monkeypatch.setattr(profile, "contracted", counted)
    monkeypatch.setattr(profile, "FEW_BLOCKS", 500)
    blocks, scored = spark.createDataFrame(rows, "chain long, block long, parent long"), spark.createDataFrame(scores, "chain long, block long, score double")
    found = profile.heaviest_branch(blocks, scored)
    assert sorted(map(tuple, found.select("chain", "tip", "weight", "length").collect())) == want
    assert sizes and all(b < 0.95 * a for a, b in sizes) and sizes[-1][1] <= 500
