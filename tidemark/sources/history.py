"""History and validity ranges as partitioned tables: scans that prune by day and id range, and ranges that late rows change in place."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..feed import Feed
from ..functions.scalars import lenient_int, snapshot_date
from ..operators.timeline import ranged
from ..operators.windows import latest
from .shared import discard, stored

_BUCKET = re.compile(r"id_bucket_(\d+)$")
#: Ranges of ids that are stored one by one, a power of two; beyond them each doubling of the id takes half as many folders.
SINGLE = 16


def _number(df: DataFrame, id_col: str):
    return F.col(id_col) if isinstance(df.schema[id_col].dataType, T.IntegralType) else lenient_int(id_col)


def _bucket(unit: Column) -> Column:
    """The folder of a range number: itself below SINGLE, then runs of 2, 4, 8 ... ranges. It never falls as the number goes up, so a bound on ids is one on folders.

    So a day's folders grow with the logarithm of its largest id, whatever the range size, and a run later in time lays its rows out the same way.
    """
    size = F.when(unit < 0, -1 - unit).otherwise(unit)
    bits = F.length(F.bin(size))
    step = F.greatest(bits - (SINGLE.bit_length() - 1), F.lit(0))
    place = step.cast("long") * (SINGLE // 2) + F.call_function("shiftright", size, step)
    return F.when(unit < 0, -1 - place).otherwise(place)


def write_history(df: DataFrame, path: str, feed: Feed, size: int) -> None:
    """Append rows to a history laid out by created_date and by ranges of `size` ids, whose number is in the column's name; ranges of large ids share folders, see _bucket().

    Spark sizes the files.
    """
    if size < 1:
        raise ValueError("the range size must be positive")
    bucket = f"id_bucket_{size}"
    rows = df.withColumn("created_date", F.to_date(feed.created)).withColumn(bucket, _bucket(F.floor(_number(df, feed.id) / size).cast("long")))
    rows.hint("rebalance", F.col("created_date"), F.col(bucket)).write.mode("append").partitionBy("created_date", bucket).parquet(path)


def history_ranges(spark: SparkSession, path: str, feed: Feed, lower, upper, most: int, size: int) -> DataFrame:
    """(range_low, row) of rows with lower <= created < upper and ids from 0 to most, by ranges of `size` ids, whatever size they are stored in.

    Both bounds become filters on partitions, so that folders of other days and of larger ids aren't listed or read; the rest is decided row by row.
    """
    if most < 1 or size < 1:
        raise ValueError("the largest id and the range size must be positive")
    table = spark.read.parquet(path)
    bucket = next(c for c in table.columns if _BUCKET.match(c))
    width = int(_BUCKET.match(bucket)[1])
    day = lambda t: (t.date() if isinstance(t, datetime) else t if isinstance(t, date) else datetime.fromisoformat(str(t)).date())
    step = lambda unit: max(unit.bit_length() - (SINGLE.bit_length() - 1), 0)
    place = lambda unit: step(unit) * (SINGLE // 2) + (unit >> step(unit))
    number = _number(table, feed.id)
    pruned = table.where(F.col("created_date").between(F.lit(day(lower)), F.lit(day(upper))) & F.col(bucket).between(0, place(most // width)))
    rows = pruned.where((F.col(feed.created) >= F.lit(lower)) & (F.col(feed.created) < F.lit(upper)) & number.between(0, most))
    return rows.withColumn("range_low", (F.floor(number / size) * size).cast("long")).drop("created_date", bucket)


def write_versions(found: DataFrame, path: str, feed: Feed, buckets: int = 256) -> None:
    """Store validity ranges, as timeline.versions() has them, by so many hash buckets of the id."""
    rows = found.withColumn("id_hash", F.pmod(F.xxhash64(feed.id), F.lit(buckets)).cast("int"))
    rows.hint("rebalance", F.col("id_hash")).write.mode("overwrite").partitionBy("id_hash").parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("id_hash")


def update_versions(spark: SparkSession, path: str, late: DataFrame, feed: Feed, buckets: int = 256, first: str | None = None) -> int:
    """Put late rows of history into stored ranges; returns the number of objects whose ranges were made anew.

    Only buckets that hold an object of a late row are read and written, and in them only those objects' ranges are worked out again, from their present rows and the
    late ones: a day's winner is the largest key of both, so nothing else of the history is needed. The result is what versions() of all rows gives.
    Rows that repeat, or lose against the present ones, change nothing, so a run that breaks off is run again. With first, the date of a base snapshot, rows
    that count by that day are left out, as versions() does.
    """
    table = spark.read.parquet(path)
    columns = [c for c in table.columns if c not in ("valid_from", "valid_to", "id_hash")]
    days = late.select(*columns).where(F.col(feed.id).isNotNull()).withColumn("valid_from", snapshot_date(feed.created)).where(F.col("valid_from").isNotNull())
    if first is not None:
        days = days.where(F.col("valid_from") > F.lit(first).cast("date"))
    days = stored(latest(days, feed, ("valid_from",)), "late")
    ids = stored(days.select(feed.id).distinct().withColumn("id_hash", F.pmod(F.xxhash64(feed.id), F.lit(buckets)).cast("int")), "touched")
    touched = [r["id_hash"] for r in ids.select("id_hash").distinct().collect()]  # at most the number of buckets
    if touched:
        here = table.where(F.col("id_hash").isin(touched))
        held = here.join(ids.select(feed.id), feed.id, "left_semi").select(*columns, "valid_from")
        anew = ranged(latest(held.unionByName(days), feed, ("valid_from",)), feed)
        others = here.join(ids.select(feed.id), feed.id, "left_anti").select(*columns, "valid_from", "valid_to")
        # written aside first: partitions can't be read and replaced at once
        both = stored(others.unionByName(anew.select(*columns, "valid_from", "valid_to")), "ranges")
        both.withColumn("id_hash", F.pmod(F.xxhash64(feed.id), F.lit(buckets)).cast("int")).hint("rebalance", F.col("id_hash")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id_hash").parquet(path)
        discard(both)
    n = ids.count()
    discard(days, ids)
    return n
