import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_file
from tidemark.llm.queries import VOCABULARY, tokenizer_path

LIBRARY = Tokenizer.from_file(tokenizer_path())
#: It forgets pieces all the time.
FEW = token_file.Encoder(tokenizer_path(), kept=3)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        found = [*ids(text), 0]
        out.append((doc, at, len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
        at += len(found)
    return out


def got(df):
    return sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect())


def test_round_trip(spark, sf, odd, none):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd):
        assert got(token_file.token_file(docs, tokenizer_path(), VOCABULARY)) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert token_file.token_file(none, tokenizer_path(), VOCABULARY).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70), st.data())
def test_packing(bits, values, data):
    values = np.array([v & ((1 << bits) - 1) for v in values], "<u4")
    payload = token_file.pack(values, bits)
    assert len(payload) == -(-len(values) * bits // 8)
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert token_file.unpack(payload, bits, a, b).tolist() == values[a:b].tolist()


def test_width():
    assert [token_file.id_bits(v) for v in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé's 1.\t\n\r\x1c\x85   　ſ中'<|endoftext|>!"), max_size=24))
def test_pieces_give_the_ids_of_the_whole(text):
    assert FEW.encode([text])[0].tolist() == ids(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "<|", "a", "word", " ", "\n", ".", "é", "1"]), max_size=12).map("".join))
def test_added_tokens_are_found_where_the_library_finds_them(text):
    assert FEW.encode([text])[0].tolist() == ids(text)


def test_added_tokens_through_the_files(spark):
    rows = [(1, "<|endoftext|>"), (2, "a<|endoftext|>b"), (3, "end <|endoftext|> of it<|endoftext|>"), (4, "<|endoftext|><|endoftext|>"), (5, "<|endoftext |>"), (6, "word." * 200 + "<|endoftext|>" + " x" * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ids("a<|endoftext|>b") == [64, 50256, 65]
    assert got(token_file.token_file(docs, tokenizer_path(), VOCABULARY)) == expected(rows)


def test_every_text_of_the_larger_table():
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()]
    for found, whole in zip(token_file.Encoder(tokenizer_path()).encode(texts), LIBRARY.encode_batch_fast(texts, add_special_tokens=False)):
        assert found.tolist() == whole.ids


def test_other_tokenizers_get_whole_texts(tmp_path):
    from tokenizers import pre_tokenizers

    other = Tokenizer.from_file(tokenizer_path())
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Digits(individual_digits=True), pre_tokenizers.ByteLevel(add_prefix_space=False)])
    other.save(str(tmp_path / "other.json"))
    texts = ["in 2024, 1234 words.", "", "a<|endoftext|>7 77"]
    encoder = token_file.Encoder(str(tmp_path / "other.json"))
    assert not encoder.byte_level and token_file.Encoder(tokenizer_path()).byte_level
    assert [e.tolist() for e in encoder.encode(texts)] == [other.encode(t, add_special_tokens=False).ids for t in texts]
