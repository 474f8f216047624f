"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import BATCH_BYTES, discard, new_path, shared_dir, small_batches  # noqa: F401

#: White space that ends a word, as a regular expression; bytes.split() cuts at the same bytes.
SPACE = r"[\x20\x09-\x0D]+"
#: A side of narrow rows is broadcast only if it has, counted, no more than this (64 MB at 64 bytes); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def keep(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path, schema = new_path(spark, name), df.schema
    with small_batches(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def keep_told(df: DataFrame, name: str, *facts: Column) -> tuple[DataFrame, tuple]:
    """keep(), and the values of some aggregates of the rows, observed as they are written."""
    seen = Observation()
    table = keep(df.observe(seen, *[f.alias(f"f{k}") for k, f in enumerate(facts)]), name)
    return table, tuple(seen.get[f"f{k}"] for k in range(len(facts)))


def large(df: DataFrame) -> DataFrame:
    """df in a join that shuffles, however small Spark takes it to be: its sizes leave out the rows that an explode makes of one, and what compression saves."""
    return df.hint("merge")


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, broadcast in a join if its rows, counted, are at most BROADCAST_ROWS, and else never."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else large(df)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves the remainder; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null reads as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words between white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null reads as empty."""
    import pyarrow as pa

    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(binary).to_pylist()]


def majority(hashes) -> int:
    """The unsigned number whose bits are set in over half of the hashes, an array of unsigned 64-bit ones; none: 0."""
    import numpy as np

    columns = hashes.view(np.uint8).reshape(len(hashes), 8)
    bits = np.arange(256)[:, None] >> np.arange(8)[None, :] & 1
    counts = np.concatenate([np.bincount(columns[:, k], minlength=256) @ bits for k in range(8)])
    return int(sum(1 << k for k in np.flatnonzero(counts * 2 > len(hashes)).tolist()))


def equal_runs(values):
    """(start, end) of runs of equal values."""
    import numpy as np

    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labelled_sample(labels: DataFrame, column: str, train: Column, rows: int, id_col: str = "doc_id") -> DataFrame:
    """(sample_id, label) of at most so many labelled rows for training, those with the smallest hash of the id.

    Rows without a label are left out; an id with several labels has the largest.
    """
    one = labels.where(train & F.col(column).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("sample_id")).agg(F.max(column).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("sample_id"), "sample_id").limit(rows)
