"""Updates applied to a base snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..feed import Feed
from ..functions.canonical import ordered_ids
from .windows import in_window, latest

NEW, UPDATED, UNCHANGED, IGNORED, CARRIED = "new", "updated", "unchanged", "ignored_older", "carried"


def apply_updates(base: DataFrame, updates: DataFrame, feed: Feed) -> DataFrame:
    """The new snapshot with the column `change`: what the update did to each object, or carried without one.

    An update replaces the base row only if its key is strictly larger. One that isn't is unchanged if all its columns equal the
    base row's, else ignored_older. base and updates have one row for each object and the same columns.
    """
    content = feed.content(base)
    old = base.select(F.col(feed.id), *[F.col(c).alias(f"_b_{c}") for c in content], F.lit(True).alias("_old"))
    new = updates.select(F.col(feed.id), *[F.col(c).alias(f"_u_{c}") for c in content], F.lit(True).alias("_new"))
    both = old.join(new, feed.id, "full_outer")
    larger = feed.key("_u_") > feed.key("_b_")
    same = reduce(lambda a, b: a & b, [feed.comparable(base, c, "_b_").eqNullSafe(feed.comparable(base, c, "_u_")) for c in content])
    change = F.when(F.col("_new").isNull(), CARRIED).when(F.col("_old").isNull(), NEW).when(larger, UPDATED).when(same, UNCHANGED).otherwise(IGNORED)
    both = both.withColumn("change", change)
    wins = F.col("change").isin(NEW, UPDATED)
    return both.select(feed.id, *[F.when(wins, F.col(f"_u_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in content], "change")


def build_snapshot(base: DataFrame, history: DataFrame, feed: Feed, base_as_of, cutoff) -> DataFrame:
    """The snapshot at the cutoff: the base with the latest rows of the window from the base's time to the cutoff."""
    if not base_as_of < cutoff:
        raise ValueError(f"base state {base_as_of} is not before the cutoff {cutoff}")
    return apply_updates(base, latest(in_window(history, feed, base_as_of, cutoff), feed), feed)


def delta_summary(changes: DataFrame, feed: Feed, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of each kind of change and the ids of each, in integer order."""
    kinds = (NEW, UPDATED, UNCHANGED, IGNORED)
    counts = [F.count_if(F.col("change") == k).alias(f"{k}_count") for k in (*kinds, CARRIED)]
    ids = [F.collect_list(F.when(F.col("change") == k, F.col(feed.id).cast("string"))).alias(f"{k}_ids") for k in kinds]
    found = changes.groupBy(*by).agg(F.count_if(F.col("change") != CARRIED).alias("deduped_count"), *counts, *ids)
    return found.select(*by, "deduped_count", *[f"{k}_count" for k in (*kinds, CARRIED)], *[ordered_ids(f"{k}_ids").alias(f"{k}_ids") for k in kinds])
