from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import mixing


def quotients(weights, seats, most):
    got = [0] * len(weights)
    for _ in range(min(seats, sum(m for w, m in zip(weights, most) if w))):
        i = max((i for i in range(len(weights)) if got[i] < most[i] and weights[i]), key=lambda i: (Fraction(weights[i], 2 * got[i] + 1), -i))
        got[i] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 40)), min_size=1, max_size=8), st.integers(0, 120))
def test_seats_go_by_highest_quotient(parties, seats):
    weights, most = zip(*parties)
    assert mixing.sainte_lague(list(weights), seats, list(most)) == quotients(weights, seats, most)


def test_targets_are_capped_and_the_excess_reshared():
    assert mixing.capped_targets([10, 1000, 1000], [3, 1, 2], Fraction(3, 2)) == [20, Fraction(2995, 3), Fraction(5990, 3)]
    assert mixing.capped_targets([], [], Fraction(3, 2)) == []
    assert mixing.capped_targets([0], [3], Fraction(3, 2)) == [0]


def test_mix(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    words = {r.doc_id: len(r.text.encode().split()) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == words and len(rows) == len(words)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    for s in set(source.values()):
        own = [r for r in rows if r.source == s]
        assert {r.source_size for r in own} == {sum(r.size for r in own)}
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.03 * own[0].target
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect())) == sorted(map(tuple, rows))
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in found)
    assert {r.size for r in found if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixed_repeats_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken / r.size for r in mixing.mix(docs).collect() if r.size}
    seen = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert seen == {d: int(t + 0.5) for d, t in taken.items() if int(t + 0.5)}


def test_drawn_copies_keep_long_documents_shares(spark):
    docs = spark.createDataFrame([(i, "w " * (8000 if i % 10 == 0 else 300), "ab"[i % 1000 >= 300]) for i in range(2000)], "doc_id long, text string, source string")
    options = {"weights": (1, 9), "share": Fraction(3, 10)}
    taken = mixing.mix(docs, **options).collect()
    emitted = mixing.mixed(docs, draw=12, **options).groupBy("source", "doc_id").count().collect()
    assert {r["count"] for r in emitted} <= {1, 2}
    copies = {r.doc_id: r["count"] for r in emitted}
    for source in "ab":
        for long in (True, False):
            rows = [r for r in taken if r.source == source and (r.size > 1000) == long]
            assert abs(sum(r.size * copies.get(r.doc_id, 0) for r in rows) - sum(r.taken for r in rows)) <= 2 * max(r.size for r in rows)
    assert sum(r.size for r in taken if r.source == "a" and r.size > 1000)
    again = mixing.mixed(docs.repartition(7), draw=12, **options).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in again} == copies


def test_drawn_copies_of_odd_rows(odd, none):
    out = mixing.mixed(odd, draw=12)
    assert out.columns == odd.columns and out.count() <= 2 * odd.count() and mixing.mixed(none, draw=12).count() == 0


def hashed(spark, rows, kinds):
    """xxhash64 of each row's values, as Spark computes it."""
    names = [f"c{k}" for k in range(len(kinds))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return [r.h for r in df.select("i", F.xxhash64(*names).alias("h")).orderBy("i").collect()]


def brute(spark, docs, share=Fraction(3, 2), weights=(3, 1, 2), seed=9):
    """(doc_id, source, size, taken) of every row, block by block and word by word."""
    rows = sorted(((r.doc_id, r.source, len((r.text or "").encode().split()), r.h) for r in docs.select("doc_id", "source", "text", F.xxhash64("text").alias("h")).collect()), key=str)
    copy = [sum(x == r for x in rows[:i]) for i, r in enumerate(rows)]
    order = hashed(spark, [(r[0], r[3], c, seed) for r, c in zip(rows, copy)], ("long", "long", "long", "int"))
    deal = hashed(spark, [(r[0], r[3], c, seed + 1) for r, c in zip(rows, copy)], ("long", "long", "long", "int"))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(r[2] for r in rows if r[1] == s) for s in sources]
    targets = mixing.capped_targets(sizes, [weights[i % 3] for i in range(len(sizes))], share)
    near = lambda x: int(Fraction(x) + Fraction(1, 2))
    block = mixing.BLOCK_WORDS
    seats = quotients(targets, round(sum(targets) / block), [2 * max(1, round(n / block)) if n else 0 for n in sizes])
    out = []
    for s, n, q in zip(sources, sizes, seats):
        shards = max(1, -(-n // mixing.SHARD_WORDS))
        sets = max(k for k in range(1, shards + 1) if (k - 1) ** 2 < shards)
        mine = sorted((deal[i] % shards, order[i], rows[i][0], rows[i][2], rows[i][3], copy[i]) for i in range(len(rows)) if rows[i][1] == s and rows[i][2])
        out += [(*r[:3], 0) for r in rows if r[1] == s and not r[2]]
        cells = {h: sum(m[3] for m in mine if m[0] == h) for h in sorted({m[0] for m in mine})}
        blocks = {h: max(1, near(Fraction(c, block))) for h, c in cells.items()}
        groups = sorted({h % sets for h in cells})
        own = dict(zip(groups, quotients([sum(c for h, c in cells.items() if h % sets == g) for g in groups], q, [2 * sum(b for h, b in blocks.items() if h % sets == g) for g in groups])))
        for g in groups:
            inside = [h for h in cells if h % sets == g]
            for h, quota in zip(inside, quotients([cells[h] for h in inside], own[g], [2 * blocks[h] for h in inside])):
                b, c = blocks[h], cells[h]
                drawn = hashed(spark, [(k, h, seed + 2) for k in range(b)], ("long", "long", "int"))
                more = sorted(range(b), key=lambda k: drawn[k])[: quota % b]
                times = [quota // b + (k in more) for k in range(b)]
                words = [t for k, t in enumerate(times) for _ in range((k + 1) * c // b - k * c // b)]
                at = 0
                for _, _, doc, size, _, _ in (m for m in mine if m[0] == h):
                    out.append((doc, s, size, sum(words[at : at + size])))
                    at += size
    return sorted(out, key=str)


def test_taken_against_brute_force(spark, sf, odd, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120").select("doc_id", "text", "source")
    more = spark.createDataFrame([(None, "a b c", "src1"), (None, "d e", "src1"), (7000, "same row here", None)] + [(7001, "same row " * 9, "src2")] * 5, "doc_id long, text string, source string")
    for table in (docs.union(more), odd.select("doc_id", "text", "source")):
        for words in (1_000_000, 2500):
            monkeypatch.setattr(mixing, "SHARD_WORDS", words)
            found = sorted(((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix(table).collect()), key=str)
            assert found == brute(spark, table)


def test_clashing_names(spark):
    names = ["_copy", "_times", "_taken", "_ratio", "_copies", "_id", "row", "id", "u", "times", "copy", "_score", "size", "hash"]
    docs = spark.createDataFrame([(i, "w " * 50, "ab"[i % 2], *range(len(names))) for i in range(20)], "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    for draw in (None, 12):
        out = mixing.mixed(docs, draw=draw)
        assert out.columns == docs.columns and 0 < out.count() <= 40
    assert mixing.mix(docs).count() == 20
