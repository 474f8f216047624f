import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import piece_model as pm

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return pm.Encoder(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(library, n):
    rng = random.Random(9)
    alphabet = list("abcdefghistnoer  ▁▁\t\n.,;()'\"0129éßñАбв中文\U0001f600\x00\x7fﬁ​�")
    pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    for k in range(n):
        if k % 3 == 0:
            yield "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6)))
        elif k % 3 == 1:
            yield "".join(rng.choice(alphabet) for _ in range(rng.randrange(14)))
        else:
            yield "".join(rng.choice("ab te▁insr") for _ in range(rng.randrange(90)))


def test_ids_are_the_librarys(encoder, library):
    all_ = [*texts(library, 15_000), "x" * 5000, "the " * 3000, "\n" * 200, " " * 70, "", " "]
    for lo in range(0, len(all_), 500):
        part = all_[lo : lo + 500]
        assert [x.tolist() for x in encoder.encode(part)] == library.encode(part)


def test_decoded_texts_are_the_librarys(encoder, library):
    rng = random.Random(10)
    for _ in range(20_000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), 29871]) for _ in range(rng.randrange(7))]
        assert encoder.decode(ids) == library.decode(ids), ids


def test_every_prefix_has_one_last_piece(encoder, library):
    text = "▁Unbelievably"
    for k in range(1, len(text) + 1):
        ids = encoder.encode([text[1:k]])[0].tolist() if k > 1 else []
        ends = [p for p in encoder.score if text[:k].endswith(p) and encoder._ends(p)]
        fit = []
        for p in ends:
            before = library.encode(text[1 : k - len(p)]) if k > len(p) + 1 else [library.piece_to_id("▁")] if k == len(p) + 1 else [None]
            if encoder._follows(before[-1], p):
                fit.append(encoder.id[p])
        assert len(fit) == 1 and (not ids or fit == ids[-1:])


def test_states_are_forgotten_without_a_change(encoder, library, monkeypatch):
    monkeypatch.setattr(pm, "STATES", 500)
    for t in texts(library, 600):
        assert encoder.encode([t])[0].tolist() == library.encode(t)


def test_models_of_another_kind_are_an_error(encoder):
    other = pm.Encoder.__new__(pm.Encoder)
    other.library, other.bytes, other.score = encoder.library, encoder.bytes, {"a": -1.25}
    with pytest.raises(ValueError):  # scores that aren't ranks: not merges
        other._require_merges(encoder.names)
    other.bytes, other.score = {}, encoder.score
    with pytest.raises(ValueError):  # no bytes to fall back to
        other._require_merges(encoder.names)


def test_rows(spark, odd, none, library):
    want = []
    for r in odd.collect():
        ids = library.encode(r.text or "")
        told = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append((r.doc_id, len(ids), *told))
    assert sorted(map(tuple, pm.digests(odd, PATH).collect())) == sorted(want)
    assert {tuple(r.ids): r.decoded for r in pm.encoded(odd, PATH).collect()} == {tuple(x): library.decode(x) for x in (library.encode(r.text or "") for r in odd.collect())}
    assert pm.digests(none, PATH).count() == 0
    assert pm.encoded(spark.createDataFrame([(None, "no id")], "doc_id long, text string"), PATH).first().doc_id is None


def test_query_over_the_whole_table(spark, library):
    from tidemark.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries()["op13_pieces"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "")
        assert got[r.doc_id] == (len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))])
