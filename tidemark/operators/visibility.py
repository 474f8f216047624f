"""What an observation shows of an archive: missing, unknown and reappeared objects, and streaks over days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unknown(observed: DataFrame, archived: DataFrame, keys: list[str]) -> DataFrame:
    """Observed objects that the archive doesn't hold."""
    return observed.join(archived.select(*keys), keys, "left_anti").select(*keys)


def streaks(archived: DataFrame, observed: DataFrame, audits: DataFrame, id_col: str = "object_id", date_col: str = "date", at_col: str = "observed_at") -> DataFrame:
    """(date, id, present, missing_days, first_missing, reappeared, missing_since) of every archived object and audited day.

    archived and observed have one row for each day and object, audits one for each audited day and the time of its
    observation. missing_days counts the consecutive audits that miss the object up to this day, first_missing is the
    time of the first. A day without an audit, or one the object isn't archived on, ends a streak. reappeared: present, and missed
    the day before; missing_since is then the time of that streak's first audit.
    """
    seen = observed.select(date_col, id_col).distinct().withColumn("_seen", F.lit(True))
    days = archived.select(date_col, id_col).distinct().join(audits.select(date_col, at_col), date_col, "left").join(seen, [date_col, id_col], "left")
    days = days.withColumn("present", F.when(F.col(at_col).isNotNull(), F.coalesce("_seen", F.lit(False))))
    order = Window.partitionBy(id_col).orderBy(date_col)
    follows = F.lag(date_col).over(order).eqNullSafe(F.date_sub(date_col, 1))
    missing = F.col("present").eqNullSafe(F.lit(False))
    breaks = F.when(missing & F.col("_follows"), 0).otherwise(1)
    days = days.withColumn("_follows", follows).withColumn("_island", F.sum(breaks).over(order))
    inside = Window.partitionBy(id_col, "_island").orderBy(date_col)
    days = days.withColumn("_n", F.count_if(missing).over(inside)).withColumn("_first", F.min(F.when(missing, F.col(at_col))).over(inside))
    back = F.col("present") & F.col("_follows") & F.lag("present").over(order).eqNullSafe(F.lit(False))
    days = days.withColumn("reappeared", F.coalesce(back, F.lit(False))).withColumn("missing_since", F.when(back, F.lag("_first").over(order)))
    found = days.where(F.col("present").isNotNull())
    return found.select(date_col, id_col, "present", F.when(~F.col("present"), F.col("_n")).otherwise(0).cast("long").alias("missing_days"), F.when(~F.col("present"), F.col("_first")).alias("first_missing"), "reappeared", "missing_since")


def audit_day(archived: DataFrame, observed: DataFrame, previous: DataFrame, observed_at, id_col: str = "object_id") -> DataFrame:
    """One day's audit against the state the day before left.

    previous has (id, first_missing, missing_days, last_seen) of objects that were missing then. Returns every archived object with present,
    reappeared, missing_since, and for missing ones first_missing, missing_days and last_seen.
    """
    seen = observed.select(id_col).distinct().withColumn("present", F.lit(True))
    prior = previous.select(id_col, *[F.col(c).alias(f"_{c}") for c in ("first_missing", "missing_days", "last_seen")]).withColumn("_was", F.lit(True))
    at = F.lit(observed_at)
    days = archived.join(seen, id_col, "left").join(prior, id_col, "left").withColumn("present", F.coalesce("present", F.lit(False))).withColumn("_was", F.coalesce("_was", F.lit(False)))
    gone = ~F.col("present")
    return days.withColumns(
        {
            "reappeared": F.col("present") & F.col("_was"),
            "missing_since": F.when(F.col("present") & F.col("_was"), F.col("_first_missing")),
            "first_missing": F.when(gone, F.coalesce("_first_missing", at)),
            "missing_days": F.when(gone, F.coalesce("_missing_days", F.lit(0)) + 1),
            "last_seen": F.when(gone, F.col("_last_seen")),
        }
    ).drop("_was", "_first_missing", "_missing_days", "_last_seen")
