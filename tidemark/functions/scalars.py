"""Column expressions over the text fields of catalog rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_text(c: str | Column) -> Column:
    """A UTC time as text without one trailing Z; a missing one is ''."""
    return F.regexp_replace(F.coalesce(as_column(c), F.lit("")), "Z$", "")


def lenient_int(c: str | Column) -> Column:
    """An integer from text with a sign and blanks around allowed; anything else, null included, is 0.

    Values are decimal(38,0); more digits than that give 0. Only ASCII digits count.
    """
    text = F.trim(as_column(c).cast("string"))
    return F.coalesce(F.when(text.rlike(r"^[+-]?\d{1,38}$"), text.try_cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def selection_key(created: str | Column, tie: str | Column, epoch: str | Column) -> Column:
    """Publication time, numeric tie breaker, then epoch: the larger one wins. Texts compare as texts."""
    return F.struct(time_text(created).alias("created"), lenient_int(tie).alias("tie"), time_text(epoch).alias("epoch"))


def parse_date(c: str | Column) -> Column:
    """yyyy-MM-dd to a date; other text is an error when the query runs."""
    return F.to_date(as_column(c), "yyyy-MM-dd")


def date_text(c: str | Column) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd")


def previous_date(c: str | Column) -> Column:
    return F.date_sub(as_column(c), 1)


def cutoff(c: str | Column) -> Column:
    """Midnight UTC at which the day's window ends."""
    return as_column(c).cast("timestamp_ntz")


def snapshot_date(created: str | Column) -> Column:
    """The first day whose snapshot holds a row: the day after its publication, as windows end before midnight."""
    return F.date_add(F.to_date(as_column(created)), 1)


def utc_stamp(c: str | Column) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def compact(record: str | Column, name: str = "OBJECT_NAME", id_field: str = "NORAD_CAT_ID", tie: str = "GP_ID") -> Column:
    """Five fields of a record map."""
    r = as_column(record)
    return F.struct(r[id_field].alias("object_id"), r[name].alias("object_name"), r["EPOCH"].alias("epoch"), r["CREATION_DATE"].alias("creation_date"), r[tie].alias("tie"))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(date): every day from start to end; an end before the start is an error."""
    if end < start:
        raise ValueError(f"end {end} is before start {start}")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))


def id_ranges(spark: SparkSession, most: int, size: int) -> DataFrame:
    """(low, high): ranges of so many ids that cover 0 to most."""
    if most < 1 or size < 1:
        raise ValueError("the largest id and the range size must be positive")
    low = spark.range(0, most + 1, size).select(F.col("id").alias("low"))
    return low.select("low", F.least(F.col("low") + size - 1, F.lit(most)).alias("high"))
