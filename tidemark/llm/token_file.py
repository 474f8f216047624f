"""Token ids as fixed-width packed blocks.

Format: a folder of Parquet files whose rows are blocks, in ascending document order over the shards (one shard for
each task that wrote). A block has shard, block (its number in the shard), first (ids of the shard before it), ids (how many), bits (width of an
id), doc_ids and doc_at (the documents in it, and where each starts, counted in ids from the block's start; one more entry ends the last) and
payload: the ids, each in `bits` bits, lowest bit first, without gaps. Id k of a block stands at bit k * bits, so any
id or range is read without its neighbours. The container gives atomic, retried writes on any file system that Spark knows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_dir, small_batches

#: Ids that close a block; a block holds whole documents, so a longer one has a block to itself.
BLOCK_IDS = 1 << 17
#: UTF-8 bytes of text that a shard gets on average.
SHARD_BYTES = 48 << 20

BLOCK_TYPE = T.StructType(
    [T.StructField(n, t) for n, t in (("shard", T.IntegerType()), ("block", T.IntegerType()), ("first", T.LongType()), ("ids", T.LongType()), ("bits", T.IntegerType()), ("doc_ids", T.ArrayType(T.LongType())), ("doc_at", T.ArrayType(T.LongType())), ("payload", T.BinaryType()))]
)


def id_bits(vocabulary: int) -> int:
    """The least width that holds every id below the vocabulary's size, 1 at least."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids, bits: int) -> bytes:
    """The ids, each in so many bits, lowest bit first. An id that needs more bits is an error."""
    import numpy as np

    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(rows, bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int):
    """Ids start..stop-1 of a packed block, reading only their bytes."""
    import numpy as np

    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", stop - start, start * bits // 8).astype("<u4")
    first, skip = divmod(start * bits, 8)
    n = (stop - start) * bits
    flat = np.unpackbits(np.frombuffer(payload, np.uint8, -(-(skip + n) // 8), first), bitorder="little")[skip : skip + n]
    whole = np.zeros((stop - start, 32), np.uint8)
    whole[:, :bits] = flat.reshape(-1, bits)
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


#: Pieces whose ids a task remembers at once.
KEPT = 500_000


class Encoder:
    """Ids of whole texts by the tokenizers library, with the ids of a piece kept for its next appearance.

    Pieces are only cut where the tokenizer itself must cut: first at its added tokens, which the library finds in a text before
    anything else; then, for a byte-level tokenizer, where its splitting rule always cuts, which is where white space begins, and at ASCII
    punctuation after a Latin letter. So the ids of the pieces, one after the other, are those of the text. A piece that is a run of Latin
    letters, with or without a space before it, is one pre-token and goes straight to the library's BPE model; others go through
    the whole tokenizer. A tokenizer of any other kind gets whole texts. kept is the number of pieces that are remembered at once.
    """

    #: White space as Unicode has it, which is what the vocabulary's splitting rule uses.
    SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    LETTERS, PUNCTUATION = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-/:-@\[-`{-~"

    def __init__(self, path: str, kept: int = KEPT):
        import re

        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), kept
        self.byte_level = self._is_byte_level()
        found = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        #: The longest of added tokens that begin at one place counts.
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(found, key=len, reverse=True))) + ")") if found else None
        self.fixed = {t: k.to_bytes(4, "little") for t, k in found.items()}
        self.ids: dict[str, bytes] = dict(self.fixed)
        self.pieces = re.compile(f"[{self.SPACES}]*[{self.PUNCTUATION}]*[{self.LETTERS}]++(?=[{self.PUNCTUATION}])|[{self.SPACES}]*[^{self.SPACES}]+|[{self.SPACES}]+").findall
        self.plain = re.compile(f" ?[{self.LETTERS}]+").fullmatch
        shown = [b for b in range(256) if chr(b).isprintable() and b != 0x20 and not 0x7F <= b <= 0xA0 and b != 0xAD]
        hidden = [b for b in range(256) if b not in shown]
        #: The character that stands for each byte in a byte-level vocabulary.
        self.shown = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}

    def _is_byte_level(self) -> bool:
        """True if the tokenizer is BPE over bytes with the usual splitting rule, and added tokens are plain strings."""
        import json

        told = json.loads(self.tokenizer.to_str())
        rule, model = told["pre_tokenizer"] or {}, told["model"]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        fine = model.get("type") == "BPE" and not any(model.get(k) for k in odd) and rule.get("type") == "ByteLevel" and rule.get("use_regex") and not rule.get("add_prefix_space")
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        return bool(fine and not told["normalizer"] and not told["truncation"] and not told["padding"] and not any(t.single_word or t.lstrip or t.rstrip for t in tokens))

    def _split(self, text: str) -> list[str]:
        if not self.added or not self.added.search(text):
            return self.pieces(text)
        out = []
        for k, part in enumerate(self.added.split(text)):
            out += [part] if k % 2 else self.pieces(part)
        return out

    def _learn(self, new: set[str]) -> None:
        from array import array

        known, tokenize = self.ids, self.tokenizer.model.tokenize
        plain = list(filter(self.plain, new))
        bytes_ = "\n".join(plain).encode().decode("latin-1").translate(self.shown).split(self.shown[10]) if plain else []
        for p, b in zip(plain, bytes_):
            known[p] = array("I", [t.id for t in tokenize(b)]).tobytes()
        other = list(new.difference(plain))
        for at in range(0, len(other), 20_000):
            part = other[at : at + 20_000]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[p] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str]) -> list:
        """The ids of each text as uint32 arrays."""
        import numpy as np

        if not self.byte_level:
            return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = [self._split(t) for t in texts]
        new = set().union(*split) - self.ids.keys()
        if len(self.ids) + len(new) > self.most:
            self.ids = dict(self.fixed)
            new = set().union(*split) - self.ids.keys()
        self._learn(new)
        get = self.ids.__getitem__
        return [np.frombuffer(b"".join(map(get, s)), "<u4") for s in split]


def write(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT) -> None:
    """Encode every whole text, end each document with end_id and write packed blocks in ascending id order.

    Null texts are empty (the end id alone). Null ids come first. Rows with the same id follow each other by text. A long text is encoded
    whole and has a block to itself. Extra columns are ignored, whatever their names; an empty table writes a folder without blocks. tokenizer is a file that every executor can open, vocabulary its number of ids, kept the pieces that a task remembers at once.
    """
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = id_bits(max(vocabulary, end_id + 1))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), Encoder(tokenizer, kept)
        end, block, first, held, ids = np.array([end_id], "<u4"), 0, 0, 0, []
        doc_ids, doc_at = [], [0]

        def closed():
            payload = pack(np.concatenate(ids), bits)
            row = {"shard": shard, "block": block, "first": first, "ids": held, "bits": bits, "doc_ids": doc_ids, "doc_at": doc_at, "payload": payload}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("ids", pa.int64()), ("bits", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_at", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [x or "" for x in part.column(1).to_pylist()]
                for doc, found in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    ids += [found, end]
                    held += len(found) + 1
                    doc_ids.append(doc)
                    doc_at.append(held)
                    if held >= BLOCK_IDS:
                        yield closed()
                        block, first, held, ids, doc_ids, doc_at = block + 1, first + held, 0, [], [], [0]
        if ids:
            yield closed()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    rows = rows.repartitionByRange(max(1, -(-total // SHARD_BYTES)), "id").sortWithinPartitions("id", "t")
    with small_batches(docs.sparkSession):
        rows.mapInArrow(run, BLOCK_TYPE).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all documents before it."""
    blocks = spark.read.schema(BLOCK_TYPE).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("ids").alias("n"))
    before = shards.select(F.col("shard").alias("s"), F.expr("coalesce(sum(n) over (order by shard rows between unbounded preceding and 1 preceding), 0)").alias("before"))

    def run(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                at, out = one["doc_at"], []
                for k, doc in enumerate(one["doc_ids"]):
                    ids = unpack(one["payload"], one["bits"], at[k], at[k + 1])
                    out.append((one["shard"], doc, one["first"] + at[k], at[k + 1] - at[k], zlib.crc32(ids.tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = blocks.select("shard", "first", "bits", "doc_ids", "doc_at", "payload").mapInArrow(run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(before, found["shard"] == before["s"]).select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_file(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, kept: int = KEPT) -> DataFrame:
    """Write the packed files (to a new folder in the shared one unless path is given) and read each document back from them.

    See write() for nulls, empty and long texts, ties, repeated rows, empty tables and extra columns.
    """
    path = path or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, vocabulary, end_id, id_col, text_col, kept)
    return read(docs.sparkSession, path)
