"""Publication windows and the latest row of each object."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..feed import Feed


def in_window(df: DataFrame, feed: Feed, lower=None, upper=None) -> DataFrame:
    """Rows with lower <= created < upper; a bound may be None. The comparison reaches the Parquet scan.

    Texts compare as texts, so callers with text times pass them through time_text first.
    """
    if lower is not None:
        df = df.where(F.col(feed.created) >= F.lit(lower))
    return df if upper is None else df.where(F.col(feed.created) < F.lit(upper))


def latest(df: DataFrame, feed: Feed, by: tuple[str, ...] = ()) -> DataFrame:
    """The row with the largest key of each object, in each group of `by`. Rows without an id are left out.

    Equal keys with different content are decided by a hash of the content. The rank limit runs before the shuffle too,
    so an object with very many rows sends one from each task.
    """
    order = [F.col(c).desc_nulls_last() for c in (feed.created, *feed.ties)] + [F.col("_content").desc()]
    ranked = df.where(F.col(feed.id).isNotNull()).withColumn("_content", feed.content_hash(df))
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(*by, feed.id).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank", "_content")


def pull(df: DataFrame, feed: Feed, lower, upper) -> tuple[DataFrame, DataFrame]:
    """The window's latest rows, and (raw_rows, objects) as a one-row table."""
    rows = in_window(df, feed, lower, upper)
    return latest(rows, feed), rows.agg(F.count("*").alias("raw_rows"), F.count_distinct(feed.id).alias("objects"))
