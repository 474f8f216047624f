"""The latest row of each object and day over a stream, and running state from its closed days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..feed import Feed
from ..operators.merge import apply_updates
from ..operators.windows import latest


def daily_latest(stream: DataFrame, feed: Feed, delay: str = "0 seconds") -> DataFrame:
    """(window_date, row): each object's row with the largest key in each day, sent once the watermark has passed the day.

    Rows that come after their day is closed are dropped, as a closed window never changes.
    """
    rows = stream.withColumn("_at", F.col(feed.created).cast("timestamp")).withWatermark("_at", delay)
    columns = [c for c in stream.columns if c != feed.id]
    best = F.max_by(F.struct(*columns), feed.key()).alias("_row")
    days = rows.where(F.col(feed.id).isNotNull()).groupBy(F.window("_at", "1 day"), feed.id).agg(best)
    return days.select(F.to_date("window.start").alias("window_date"), feed.id, "_row.*")


def run_daily(stream: DataFrame, feed: Feed, path: str, checkpoint: str, delay: str = "0 seconds"):
    """Write closed days to a Parquet folder; returns the query, which ends when the available input is read."""
    out = daily_latest(stream, feed, delay).writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return out.partitionBy("window_date").trigger(availableNow=True).start()


def fold_state(feed: Feed, path: str):
    """A foreachBatch function that applies each batch of closed days to the state under path, one folder for each batch.

    A batch that is repeated after a failure reads the folder before its own and writes its own again, so it counts once.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = latest(batch.drop("window_date"), feed)
        before = f"{path}/{number - 1}"
        state = spark.read.parquet(before) if number else rows.where("1 = 0")
        apply_updates(state, rows, feed).drop("change").write.mode("overwrite").parquet(f"{path}/{number}")

    return step
