"""Canonical JSON text of records, and SHA-256 hashes of rows, id sets and tables."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import as_column, lenient_int

#: A place before a \uXXXX escape whose backslash isn't escaped itself (up to 200 escaped ones before it).
_BEFORE_ESCAPE = r"(?<=(?<!\\)(?:\\\\){0,200})(?=\\u[0-9A-F]{4})"


def canonical_text(record: str | Column) -> Column:
    """JSON of a map<string,string>: keys in order, no blanks, ASCII only with lower-case escapes, nulls kept."""
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(as_column(record)))), {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"})
    text = F.replace(text, F.lit("\x7f"), F.lit("\\u007f"))
    parts = F.transform(F.split(text, _BEFORE_ESCAPE), lambda x: F.when(x.rlike(r"^\\u[0-9A-F]{4}"), F.concat(F.lower(F.substring(x, 1, 6)), x.substr(F.lit(7), F.length(x)))).otherwise(x))
    return F.array_join(parts, "")


def sha256(text: str | Column) -> Column:
    return F.sha2(as_column(text).cast("binary"), 256)


def record_hash(record: str | Column) -> Column:
    return sha256(canonical_text(record))


def as_record(df: DataFrame, columns: list[str]) -> Column:
    """The columns as a map of texts, null values kept."""
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])


def ordered_ids(ids: str | Column) -> Column:
    """An array of id texts by integer value, equal ones by text."""
    pairs = F.transform(as_column(ids), lambda x: F.struct(lenient_int(x).alias("n"), x.alias("t")))
    return F.transform(F.array_sort(pairs), lambda p: p["t"])


def _streamed(df: DataFrame, by: list[str], order: list[str], start: str, between: str, end: str) -> DataFrame:
    """(by, items, bytes, sha256) of rows (by, order, c): each group's texts c in order, with what stands before, between and after them.

    A group is sorted in its partition, on disk if it must be, and passes one hasher batch by batch, so none is ever a value. Groups go in parallel; SHA-256 of one has no parallel form.
    """
    kinds = {f.name: f.dataType for f in df.schema if f.name in by}
    head, gap, tail = start.encode(), between.encode(), end.encode()

    def run(batches):
        import hashlib
        from itertools import groupby

        import pyarrow as pa

        group, hasher, items, size = None, None, 0, 0

        def told():
            hasher.update(tail)
            return [*group, items, size + len(tail), hasher.hexdigest()]

        out = []
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in range(len(by))]))
            texts, at = batch.column(len(by)).to_pylist(), 0
            for key, run_ in groupby(keys):
                n = sum(1 for _ in run_)
                if key != group:
                    if group is not None:
                        out.append(told())
                    group, hasher, items, size = key, hashlib.sha256(head), 0, len(head)
                piece = (gap if items else b"") + gap.join(t.encode() for t in texts[at : at + n])
                hasher.update(piece)
                items, size, at = items + n, size + len(piece), at + n
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if group is not None:
            out.append(told())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    schema = T.StructType([T.StructField(c, kinds[c]) for c in by] + [T.StructField("items", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_type

    names, types = schema.names, [to_arrow_type(f.dataType) for f in schema]
    return df.repartition(*by).sortWithinPartitions(*by, *order).select(*by, "c").mapInArrow(run, schema)


def id_set_hash(df: DataFrame, id_col: str, by: list[str]) -> DataFrame:
    """(by, ids, sha256): hash of each group's distinct ids in integer order, one a line. Groups may have any size."""
    ids = df.where(F.col(id_col).isNotNull()).select(*by, F.col(id_col).cast("string").alias("c")).distinct().withColumn("n", lenient_int("c"))
    return _streamed(ids, by, ["n", "c"], "", "\n", "").select(*by, F.col("items").cast("int").alias("ids"), "sha256")


def _ordered(df: DataFrame, id_col: str, record_col: str, by: list[str]) -> DataFrame:
    return df.select(*by, lenient_int(id_col).alias("n"), F.col(id_col).cast("string").alias("t"), canonical_text(record_col).alias("c"))


def catalog_texts(df: DataFrame, id_col: str, record_col: str, by: list[str]) -> DataFrame:
    """(by, objects, text): each group's records as one JSON array in integer order of the ids. A group is one value of at most 2 GB; see text_pieces() for others."""
    rows = F.struct(lenient_int(id_col).alias("n"), F.col(id_col).cast("string").alias("t"), canonical_text(record_col).alias("c"))
    whole = df.groupBy(*by).agg(F.array_sort(F.collect_list(rows)).alias("_rows"))
    return whole.select(*by, F.size("_rows").alias("objects"), F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda r: r["c"]), ","), F.lit("]")).alias("text"))


def table_hash(df: DataFrame, id_col: str, record_col: str, by: list[str]) -> DataFrame:
    """(by, objects, raw_bytes, sha256): hash of each group's records as one JSON array in integer order of the ids.

    A group may have any size: it is sorted and streamed by one task, groups in parallel. Where sorting one group is what takes the time, piece_hash() of text_pieces() sorts it in parallel first.
    """
    found = _streamed(_ordered(df, id_col, record_col, by), by, ["n", "t", "c"], "[", ",", "]")
    return found.select(*by, F.col("items").alias("objects"), F.col("bytes").alias("raw_bytes"), "sha256")


#: Bytes of a piece of a catalog's text, but for a longer record alone. Parquet is read in batches of 4,096 rows whatever their length, so one of pieces is 32 MB.
PIECE_BYTES = 1 << 13


def text_pieces(df: DataFrame, id_col: str, record_col: str, by: list[str], size: int = PIECE_BYTES) -> DataFrame:
    """(by, shard, seq, records, text): each group's records in integer order of the ids, joined by commas, in pieces of about `size` bytes.

    Pieces follow each other by shard and seq. Rows are partitioned by ranges of (by, id), so that a large group is written and sorted by many tasks; nothing has a group as a value.
    """
    kinds = [f for f in df.schema if f.name in by]

    def run(batches):
        from itertools import groupby

        import pyarrow as pa
        from pyspark import TaskContext

        shard, group, held, length, seq = TaskContext.get().partitionId(), None, [], 0, 0

        def told():
            return pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip(group, types)], pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([",".join(held)], pa.string())], names=names)

        for batch in batches:
            keys, at = list(zip(*[batch.column(k).to_pylist() for k in range(len(by))])), 0
            texts = batch.column(len(by)).to_pylist()
            for key, run_ in groupby(keys):
                if key != group:
                    if held:
                        yield told()
                    group, held, length, seq = key, [], 0, 0
                for text in texts[at : (at := at + sum(1 for _ in run_))]:
                    if held and length + len(text) > size:
                        yield told()
                        held, length, seq = [], 0, seq + 1
                    held.append(text)
                    length += len(text) + 1
        if held:
            yield told()

    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([*sorted(kinds, key=lambda f: by.index(f.name)), T.StructField("shard", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("records", T.LongType()), T.StructField("text", T.StringType())])
    names, types = schema.names, [to_arrow_type(f.dataType) for f in schema][: len(by)]
    rows = _ordered(df, id_col, record_col, by)
    return rows.repartitionByRange(*by, "n", "t", "c").sortWithinPartitions(*by, "n", "t", "c").select(*by, "c").mapInArrow(run, schema)


def piece_hash(pieces: DataFrame, by: list[str]) -> DataFrame:
    """(by, objects, raw_bytes, sha256) of text_pieces(): what table_hash() gives, with only whole pieces left to sort."""
    counts = pieces.groupBy(*by).agg(F.sum("records").alias("objects"))
    rows = pieces.select(*by, "shard", "seq", F.col("text").alias("c"))
    found = _streamed(rows, by, ["shard", "seq"], "[", ",", "]").withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return counts.join(found, reduce(lambda a, b: a & b, same)).select(*by, "objects", F.col("bytes").alias("raw_bytes"), "sha256")


def stream_hash(df: DataFrame, id_col: str, record_col: str) -> tuple[int, int, str]:
    """(objects, raw_bytes, sha256) of one table of any size: sorted in parallel, then streamed by one task. An empty table is the text []."""
    one = piece_hash(text_pieces(df.withColumn("_one", F.lit(1)), id_col, record_col, ["_one"]), ["_one"]).first()
    return (one["objects"], one["raw_bytes"], one["sha256"]) if one else (0, 2, hashlib.sha256(b"[]").hexdigest())
