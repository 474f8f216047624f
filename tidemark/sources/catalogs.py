"""Catalog files of any size, read record by record.

A catalog is a JSON list of records, usually compressed. Spark's text source unpacks a file as a stream and cuts it behind every closing brace; the cuts
of a file arrive in order, and a cutter in the task puts them together into records, tells what the audit rules ask, and keeps
one record in memory. Nothing needs a catalog as a value, and any store and codec that Spark reads will do.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import REQUIRED_FIELDS
from .shared import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FACTS = "readable boolean, sha256 string, raw_bytes long, canonical boolean, objects long, ordered boolean, incomplete boolean"


class Cutter:
    """Records of one catalog from its bytes, handed over in pieces. After finish(), facts() tells of the whole."""

    def __init__(self, id_field: str = "NORAD_CAT_ID", required: tuple[str, ...] = REQUIRED_FIELDS):
        import hashlib
        import json
        import re

        # one encoder for all records: json.dumps() would make one for each
        self.encoded = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode
        self.token = re.compile(rb'\\.|["{}\[\]]', re.S).finditer
        self.number = re.compile(r"[+-]?[0-9]{1,38}").fullmatch
        self.hasher, self.raw, self.objects = hashlib.sha256(), 0, 0
        self.depth, self.quoted, self.held, self.gap, self.ended = 0, False, [], b"", False
        self.readable, self.canonical, self.ordered, self.incomplete = True, True, True, False
        self.last, self.id_field, self.required = None, id_field, frozenset(required)

    def feed(self, data: bytes):
        """The records that end in this piece, as lists of (key, text); null values stay null, other values have the text they are written with."""
        self.hasher.update(data)
        self.raw += len(data)
        if not self.readable:
            return
        if self.depth == 1 and not self.quoted and self._is_plain(data):
            at = data.index(b"{")
            record = self._record(data[at:]) if self._may_begin(self.gap + data[:at]) else None
            self.gap = b""
            if record is None:
                self._break()
                return
            yield record
            return
        at = 0  # from here on bytes belong to the record or gap that is open
        for m in self.token(data):
            t = m.group()
            if self.quoted:
                self.quoted = t != b'"'
            elif t == b'"':
                self.quoted = True
                if self.depth < 2:
                    self._break()
                    return
            elif t in b"{[":
                if self.depth == 1:
                    if t == b"[" or not self._may_begin(self.gap + data[at : m.start()]):
                        self._break()
                        return
                    self.gap, at = b"", m.start()
                elif self.depth == 0 and (t == b"{" or self.ended):
                    self._break()
                    return
                self.depth += 1
            elif t in b"}]":
                self.depth -= 1
                if self.depth == 1:
                    record = self._record(b"".join([*self.held, data[at : m.end()]]))
                    self.held, at = [], m.end()
                    if record is None:
                        self._break()
                        return
                    yield record
                elif self.depth == 0:
                    self.ended = t == b"]"
                    if not self.ended:
                        self._break()
                        return
                elif self.depth < 0:
                    self._break()
                    return
        if self.depth > 1:
            self.held.append(data[at:])
        else:
            self.gap += data[at:]
            if len(self.gap) > 4096 and self.gap.strip(b" \t\r\n[],"):
                self._break()

    @staticmethod
    def _is_plain(data: bytes) -> bool:
        """Whether a piece is one record without lists, objects, escapes or braces inside, and what stands before it: then its last brace ends it, and no token need be looked at."""
        if not data.endswith(b"}") or data.count(b"}") != 1 or data.count(b"{") != 1 or data.count(b'"') % 2 or any(c in data for c in (b"\\", b"[", b"]")):
            return False
        return b'"' not in data[: data.index(b"{")]

    def _break(self) -> None:
        self.readable, self.held, self.gap = False, [], b""

    def _may_begin(self, gap: bytes) -> bool:
        want = b"," if self.objects else b"["
        self.canonical &= gap == want
        return gap.strip(b" \t\r\n") == want

    def _record(self, piece: bytes):
        import json

        try:
            found = json.loads(piece)
        except ValueError:
            return None
        if not isinstance(found, dict):
            return None
        self.objects += 1
        self.canonical &= self.encoded(found).encode() == piece
        self.incomplete |= not self.required <= found.keys()
        if any(v is not None and not isinstance(v, str) for v in found.values()):
            written = json.loads(piece, parse_int=str, parse_float=str, parse_constant=str)
            found = {k: v if v is None or isinstance(v, str) else str(v).lower() if isinstance(v, bool) else json.dumps(v, separators=(",", ":"), ensure_ascii=False) for k, v in written.items()}
        own = (found.get(self.id_field) or "").strip(" ")
        number = int(own) if self.number(own) else 0
        self.ordered &= self.last is None or self.last <= number
        self.last = number
        return list(found.items())

    def finish(self) -> None:
        if self.readable:
            closing = b"]" if self.objects else b"[]"
            self.readable = self.ended and self.depth == 0 and b"".join(self.gap.split()) == closing
            self.canonical &= self.gap == closing

    def facts(self) -> dict:
        ok = self.readable
        told = {"canonical": self.canonical, "objects": self.objects, "ordered": self.ordered, "incomplete": self.incomplete}
        return {"readable": ok, "sha256": self.hasher.hexdigest(), "raw_bytes": self.raw} | {k: v if ok else None for k, v in told.items()}


def _cut(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, file_bytes, value): the bytes between closing braces, those of a file in order and in one task."""
    read = spark.read.option("lineSep", "}").option("ignoreCorruptFiles", True)
    files = read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_bytes"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    if all(p.endswith(".gz") for p in paths):
        return files.drop("block")
    return files.withColumn("line", F.monotonically_increasing_id()).repartition("path").sortWithinPartitions("path", "block", "line").select("path", "file_bytes", "value")


def cuts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, at, text): the text of catalog files in pieces that end behind each closing brace, numbered from 0, as they stream by; the last one is what follows the last brace."""

    def run(batches):
        import pyarrow as pa

        kinds = (pa.string(), pa.int32(), pa.binary())
        now, at, before = None, 0, b""
        for batch in batches:
            out = []
            for path, value in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if path == now:
                    out.append((now, at, before + b"}"))
                    at += 1
                else:
                    if now is not None:
                        out.append((now, at, before))
                    now, at = path, 0
                before = value or b""
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["path", "at", "text"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((now, at, before), kinds)], names=["path", "at", "text"])

    return _cut(spark, paths).mapInArrow(run, "path string, at int, text binary").withColumn("text", F.col("text").cast("string"))


def scanned(spark: SparkSession, paths: list[str], id_field: str = "NORAD_CAT_ID", required: tuple[str, ...] = REQUIRED_FIELDS, id_alone: bool = False) -> DataFrame:
    """(path, file_bytes, pos, rec, facts) of catalog files: a row for each record, and one with facts, and no rec, at the end of each file. With id_alone a rec has no other field.

    A file that is no list of objects, or whose compression breaks off, isn't readable; the records before the break are there all the same. Compressed files
    are read by one task each; others, which Spark may split, are put together by one task.
    """
    rows = _cut(spark, paths)

    def run(batches):
        import pyarrow as pa

        facts = pa.struct([("readable", pa.bool_()), ("sha256", pa.string()), ("raw_bytes", pa.int64()), ("canonical", pa.bool_()), ("objects", pa.int64()), ("ordered", pa.bool_()), ("incomplete", pa.bool_())])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), facts)
        now, cutter, before, out = None, None, None, []

        def kept(r):
            return [e for e in r if e[0] == id_field] if id_alone else r

        def ended():
            # the last cut of a file has no brace behind it
            out.extend((*now, cutter.objects - 1, kept(r), None) for r in cutter.feed(before))
            cutter.finish()
            out.append((*now, None, None, cutter.facts()))

        def table():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["path", "file_bytes", "pos", "rec", "facts"])

        for batch in batches:
            for path, size, value in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                if now is None or now[0] != path:
                    if now is not None:
                        ended()
                    now, cutter = (path, size), Cutter(id_field, required)
                else:
                    out.extend((*now, cutter.objects - 1, kept(r), None) for r in cutter.feed(before + b"}"))
                before = value or b""
                if len(out) >= 2000:
                    yield table()
                    out.clear()
        if now is not None:
            ended()
        if out:
            yield table()

    return rows.mapInArrow(run, f"path string, file_bytes long, pos long, rec map<string,string>, facts struct<{FACTS.replace(' ', ':').replace(',:', ',')}>")


def catalog_rows(spark: SparkSession, paths: list[str], id_field: str = "NORAD_CAT_ID") -> DataFrame:
    """(path, pos, object_id, rec): the records of catalog files as they stream by; null fields are kept apart from missing ones."""
    return scanned(spark, paths, id_field).where("rec is not null").select("path", "pos", F.col("rec")[id_field].alias("object_id"), "rec")


def catalog_facts(spark: SparkSession, paths: list[str], id_field: str = "NORAD_CAT_ID", required: tuple[str, ...] = REQUIRED_FIELDS) -> DataFrame:
    """(path, compressed_bytes, catalog) of each file: what the day rules ask of a catalog, repeated ids among it. Files are read once; repeats are found by a join of all ids, not in a task."""
    ids = scanned(spark, paths, id_field, required, True).select("path", "file_bytes", F.col("rec")[id_field].alias("id"), F.col("rec").isNotNull().alias("is_record"), "facts")
    ids = stored(ids, "catalog_ids")
    repeats = ids.where("is_record").groupBy("path", "id").agg(F.count("*").alias("n")).where("n > 1").select("path").distinct().withColumn("_twice", F.lit(True))
    files = ids.where("not is_record").join(repeats, "path", "left")
    told = [F.col(f"facts.{c}").alias(c) for c in ("readable", "sha256", "raw_bytes", "canonical", "objects")]
    repeated = F.when(F.col("facts.readable"), F.coalesce("_twice", F.lit(False)))
    return files.select("path", F.col("file_bytes").alias("compressed_bytes"), F.struct(*told, repeated.alias("repeats"), F.col("facts.ordered").alias("ordered"), F.col("facts.incomplete").alias("incomplete")).alias("catalog"))
