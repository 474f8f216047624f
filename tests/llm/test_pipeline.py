import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
from test_decontaminate import brute as leaks
from test_mixing import brute as mix_brute
from test_mixing import hashed
from test_similar import brute as groups
from test_token_file import ids

import corpus_pipeline
from tidemark.llm import mixing, quality
from tidemark.llm.queries import oracle_sql, queries


def drawn_copies(spark, docs, draw):
    """How often each document stands in the mix: rests of rounding go to the next one of like size."""
    taken = [r for r in mix_brute(spark, docs) if r[2]]
    whole = Counter()
    for _, source, size, _ in taken:
        whole[source] += size
    shards = {s: -(-n // mixing.SHARD_WORDS) for s, n in whole.items()}
    ids = [d for d, *_ in taken]
    deal, order = (hashed(spark, [(d, n) for d in ids], ("long", "int")) for n in (draw + 1, draw))
    rows = sorted((s or "", deal[i] % shards[s], size, order[i], d, s, round(Fraction(t, size) * 2**32)) for i, (d, s, size, t) in enumerate(taken))
    cells = sorted({(r[5], r[1]) for r in rows}, key=str)
    start = dict(zip(cells, (h % 2**32 for h in hashed(spark, [(s, k, draw) for s, k in cells], ("string", "long", "int")))))
    copies = {}
    for _, shard, _, _, d, s, unit in rows:
        before = start[s, shard]
        start[s, shard] += unit
        copies[d] = start[s, shard] // 2**32 - before // 2**32
    return copies


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    scored = quality.score_quality(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    left = {r.doc_id for r in scored if r.predicted}
    assert len(left) < len(rows)
    left = {c for _, c in groups([(d, rows[d].text) for d in left])}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {d for d, *_ in leaks([(d, rows[d].text) for d in left], items)}
    assert bad
    left -= bad
    times = drawn_copies(spark, docs.where(docs.doc_id.isin(*left)), corpus_pipeline.DRAW)
    want, at = [], 0
    for d in sorted(left):
        found = [*ids(rows[d].text), 0]
        for _ in range(times.get(d, 0)):
            want.append((d, at, len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
            at += len(found)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want


def test_stages_keep_columns_and_take_odd_rows(spark, sf, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_registered_queries():
    names = Counter(n.split("_")[0] for n in queries())
    assert names == {**{f"op{n}": 1 for n in range(1, 11)}, "pipeline": 1}
    assert set(oracle_sql()) <= set(queries())
