"""Many days at once: versions with validity, daily states, replay from nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..feed import Feed
from ..functions.scalars import snapshot_date
from .merge import IGNORED, NEW, UNCHANGED, UPDATED
from .windows import in_window, latest


def versions(history: DataFrame, feed: Feed, base: DataFrame | None = None, base_date: str | None = None, base_as_of=None) -> DataFrame:
    """Each object's rows that ever were its state, with valid_from and valid_to (dates; valid_to null: still valid).

    The state of day D is built from rows published before D's midnight. A day's latest row becomes the state only if
    its key is above all earlier ones. base, the snapshot of base_date, takes part as the state of that day, and
    history then counts from base_as_of on. One window over the days of an object replaces the loop over days.
    """
    days = latest(in_window(history, feed, base_as_of).withColumn("valid_from", snapshot_date(feed.created)), feed, ("valid_from",))
    if base is not None:
        first = F.lit(base_date).cast("date")
        days = days.where(F.col("valid_from") > first).unionByName(base.withColumn("valid_from", first))
    return ranged(days, feed)


def ranged(days: DataFrame, feed: Feed) -> DataFrame:
    """valid_to for rows that have a valid_from, of which an object has one a day at most; rows whose key isn't above all earlier ones go."""
    by_day = Window.partitionBy(feed.id).orderBy("valid_from")
    most = F.max(feed.key()).over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    rows = days.withColumn("_most", most).where(F.col("_most").isNull() | (feed.key() > F.col("_most"))).drop("_most")
    return rows.withColumn("valid_to", F.lead("valid_from").over(by_day))


def resume(history: DataFrame, feed: Feed, snapshots: DataFrame, date_col: str = "snapshot_date", as_of_col: str = "state_as_of") -> DataFrame:
    """versions() over an archive in which some days exist already.

    snapshots holds the rows of the existing days with their date and the time their state stands for; each starts a
    segment that runs to the next one, and a row of history counts in the segment whose state time it isn't before.
    """
    starts = snapshots.select(F.col(date_col).cast("date").alias("_date"), F.col(as_of_col).alias("_as_of")).distinct()
    order = Window.orderBy("_date")  # one row for each archived day
    starts = starts.withColumn("_until", F.lead("_date").over(order))
    days = history.withColumn("valid_from", snapshot_date(feed.created))
    # each calendar day knows its segment, so history meets it by equality; the last segment ends with the history
    end = days.agg(F.max("valid_from")).first()[0]
    last = F.coalesce(F.date_sub("_until", 1), F.greatest(F.lit(end).cast("date"), F.col("_date")))
    spread = starts.where(F.date_add("_date", 1) <= last).withColumn("valid_from", F.explode(F.sequence(F.date_add("_date", 1), last)))
    own = days.join(spread, "valid_from").where(F.col(feed.created) >= F.col("_as_of"))
    own = latest(own, feed, ("_date", "valid_from")).drop("_as_of")
    base = snapshots.withColumn("_date", F.col(date_col).cast("date")).drop(date_col).withColumn("valid_from", F.col("_date")).drop(as_of_col).join(starts.select("_date", "_until"), "_date")
    rows = own.unionByName(base)
    by_day = Window.partitionBy("_date", feed.id).orderBy("valid_from")
    most = F.max(feed.key()).over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_most", most).where(F.col("_most").isNull() | (feed.key() > F.col("_most")))
    rows = rows.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(by_day), F.col("_until")))
    return rows.drop("_most", "_date", "_until")


def daily_states(found: DataFrame, start: str, end: str) -> DataFrame:
    """(snapshot_date, row): the state of every day from start to end. Validity is spread over its days, no range join."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    first = F.greatest("valid_from", lo)
    last = F.least(F.coalesce(F.date_sub("valid_to", 1), hi), hi)
    return found.withColumn("_a", first).withColumn("_z", last).where("_a <= _z").withColumn("snapshot_date", F.explode(F.sequence("_a", "_z"))).drop("_a", "_z", "valid_from", "valid_to")


def as_of(history: DataFrame, feed: Feed, cutoff) -> DataFrame:
    """The state of every object at one cutoff."""
    return latest(in_window(history, feed, upper=cutoff), feed)


def daily_changes(history: DataFrame, feed: Feed, start=None, end=None, arrived: str | None = None, base: DataFrame | None = None) -> DataFrame:
    """(window_date, id, raw_rows, change): what each daily window did to each object of a state that began as base, or empty.

    change is new, updated, unchanged or ignored_older, as in merge; of rows without an id only the number counts. Windows go by the column `arrived`,
    by default the publication time. Only ids, keys and a hash of the content are shuffled; a day's rows of an object meet in each task first.
    """
    at = arrived or feed.created
    rows = in_window(history, Feed(feed.id, at), start, end)
    content = history.drop(arrived) if arrived else history
    best = F.struct(feed.key().alias("key"), feed.content_hash(content).alias("content")).alias("_best")
    rows = rows.select(F.to_date(at).alias("window_date"), F.col(feed.id), best)
    if base is not None:  # before every window
        rows = rows.union(base.select(F.lit(None).cast("date"), F.col(feed.id), best))
    days = rows.groupBy("window_date", feed.id).agg(F.count("*").alias("raw_rows"), F.max("_best").alias("_best"))
    most = F.max("_best").over(Window.partitionBy(feed.id).orderBy("window_date").rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumn("_most", most)
    change = F.when(F.col("_most").isNull(), NEW).when(F.col("_best.key") > F.col("_most.key"), UPDATED).when(F.col("_best.content") == F.col("_most.content"), UNCHANGED).otherwise(IGNORED)
    return days.where("window_date is not null").select("window_date", feed.id, "raw_rows", F.when(F.col(feed.id).isNotNull(), change).alias("change"))


def replay_windows(history: DataFrame, feed: Feed, start, end, arrived: str | None = None) -> DataFrame:
    """What each daily window from start to end did to a state that began empty. The last window may be part of a day.

    Columns: window_date, raw_rows, deduped, applied, ignored, objects_before, objects_after. A row that is not above
    the state is ignored if it differs from it and not counted if it doesn't. Days without rows have no row.
    """
    is_ = lambda *kinds: F.count_if(F.col("change").isin(*kinds))
    days = daily_changes(history, feed, start, end, arrived).groupBy("window_date").agg(
        F.sum("raw_rows").alias("raw_rows"), F.count("change").alias("deduped"), is_(NEW, UPDATED).alias("applied"), is_(IGNORED).alias("ignored"), is_(NEW).alias("_first")
    )
    after = F.sum("_first").over(Window.orderBy("window_date"))  # one row for each day
    return days.select("window_date", "raw_rows", "deduped", "applied", "ignored", (after - F.col("_first")).alias("objects_before"), after.alias("objects_after"))


def daily_agreement(states: DataFrame, feed: Feed) -> DataFrame:
    """(snapshot_date, objects, checksum) of daily states."""
    return states.groupBy("snapshot_date").agg(F.count("*").alias("objects"), F.sum(F.col(feed.ties[0])).alias("checksum"))


def next_date(archived: DataFrame, end: str, date_col: str = "date") -> DataFrame:
    """(next_date): the day after the latest archived one, not past end; end if nothing is archived."""
    last = F.lit(end).cast("date")
    return archived.agg(F.coalesce(F.least(F.date_add(F.max(date_col), 1), last), last).alias("next_date"))


def latest_dates(archived: DataFrame, n: int, date_col: str = "date") -> DataFrame:
    """The n latest distinct dates; none for n of 0 or less."""
    return archived.select(date_col).distinct().orderBy(F.desc(date_col)).limit(max(0, n))
