"""The artifacts that describe each day of an archive: deltas, audits, visibility states, and all of them as files.

Counts are grouped aggregates. The id lists are part of the artifacts' format, so a day's ids are one value each; the tables they are
made from (timeline.daily_changes, visibility.streaks) hold the same as rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.canonical import catalog_texts, id_set_hash, ordered_ids
from ..functions.scalars import lenient_int
from .merge import IGNORED, NEW, UNCHANGED, UPDATED


def deltas(changes: DataFrame, manifests: DataFrame, id_col: str) -> DataFrame:
    """Delta artifacts of the rolling days that manifests (date, object_count, delta_window_start_utc, delta_window_end_utc) has.

    changes: (window_date, id, raw_rows, change); a window's changes make the state of the next day. Carried forward is
    what the day before held and no update met. A day without rows has zeros and empty lists.
    """
    is_ = lambda kind: F.col("change") == kind
    kinds = ((NEW, "new_object_count", "new_norad_cat_ids"), (UPDATED, "updated_object_count", "updated_norad_cat_ids"), (UNCHANGED, "unchanged_update_count", "unchanged_update_norad_cat_ids"), (IGNORED, "ignored_older_update_count", "ignored_older_update_norad_cat_ids"))
    counts = [F.count_if(is_(k)).alias(n) for k, n, _ in kinds]
    lists = [ordered_ids(F.collect_list(F.when(is_(k), F.col(id_col).cast("string")))).alias(i) for k, _, i in kinds]
    # a day's rows come together before they are listed, else every task would hold its part of all days' lists
    found = changes.withColumn("date", F.date_format(F.date_add("window_date", 1), "yyyy-MM-dd")).repartition("date").groupBy("date").agg(F.sum("raw_rows").alias("raw_row_count"), F.count("change").alias("deduped_update_count"), *counts, *lists)
    held = F.lag("object_count").over(Window.orderBy("date"))  # one row for each day
    days = manifests.select("date", F.col("delta_window_start_utc").alias("window_start_utc"), F.col("delta_window_end_utc").alias("window_end_utc"), F.coalesce(held, F.lit(0)).alias("_held"))
    both = days.where("window_start_utc is not null").join(found, "date", "left")
    numbers = ["raw_row_count", "deduped_update_count", *[n for _, n, _ in kinds]]
    both = both.withColumns({n: F.coalesce(n, F.lit(0).cast("long")) for n in numbers} | {i: F.coalesce(i, F.array().cast("array<string>")) for _, _, i in kinds})
    met = F.col("updated_object_count") + F.col("unchanged_update_count") + F.col("ignored_older_update_count")
    both = both.withColumn("carried_forward_count", F.col("_held") - met)
    return both.select("date", "window_start_utc", "window_end_utc", *numbers, "carried_forward_count", *[i for _, _, i in kinds])


def _by_id(items):
    """Structs (n, t, v) in integer order of the id, as their v."""
    return F.transform(F.array_sort(items), lambda x: x["v"])


def audits(streaks: DataFrame, names: DataFrame, observed: DataFrame, unknown: DataFrame, times: DataFrame, id_col: str = "object_id") -> tuple[DataFrame, DataFrame]:
    """(audit artifacts, visibility states) of audited days.

    streaks: visibility.streaks(); names: (date, id, object_name, created) of archived objects; observed: (date, id); unknown: (date, id) of observed objects that aren't archived;
    times: (date, observed_at) of audits. Dates are texts.
    """
    rows = streaks.join(names, ["date", id_col], "left").join(times, "date")
    text, number = F.col(id_col).cast("string"), lenient_int(id_col)
    entry = lambda *fields: F.struct(number.alias("n"), text.alias("t"), F.struct(*fields).alias("v"))
    who, gone = (text.alias("norad_cat_id"), F.col("object_name")), ~F.col("present")
    last = F.col("created").alias("last_gp_creation_date")
    streak = (F.col("first_missing").alias("first_missing_in_current_gp_audit"), F.col("missing_days").alias("consecutive_missing_audits"))
    missing = F.when(gone, entry(*who, last, *streak))
    back = F.when(F.col("reappeared"), entry(*who, F.col("observed_at").alias("reappeared_at_utc"), F.col("missing_since").alias("previously_missing_since")))
    state = F.when(gone, entry(*who, last, F.lit(None).cast("string").alias("last_seen_in_current_gp_audit"), *streak))
    days = rows.repartition("date").groupBy("date").agg(
        F.count("*").alias("archive_object_count"), F.count_if(gone).alias("missing_from_current_gp_count"), F.count_if("reappeared").alias("reappeared_in_current_gp_count"),
        _by_id(F.collect_list(missing)).alias("missing_from_current_gp"), _by_id(F.collect_list(back)).alias("reappeared_in_current_gp"), _by_id(F.collect_list(state)).alias("_state"),
    )
    seen = observed.groupBy("date").agg(F.count("*").alias("current_gp_object_count")).join(id_set_hash(observed, id_col, ["date"]).select("date", F.col("sha256").alias("present_ids_sha256")), "date")
    others = unknown.repartition("date").groupBy("date").agg(F.count("*").alias("_n"), ordered_ids(F.collect_list(text)).alias("_ids"))
    both = times.select("date", F.col("observed_at").alias("observed_at_utc")).join(days, "date", "left").join(seen, "date", "left").join(others, "date", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    empty = lambda c: F.coalesce(c, F.expr(f"slice({c}, 1, 0)"), F.from_json(F.lit("[]"), days.schema[c].dataType)).alias(c)
    audit = both.select(
        "date", "observed_at_utc", zero("archive_object_count"), zero("current_gp_object_count"), F.coalesce("present_ids_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("present_ids_sha256"), zero("missing_from_current_gp_count"),
        F.coalesce("_n", F.lit(0).cast("long")).alias("present_in_current_gp_not_in_archive_count"), zero("reappeared_in_current_gp_count"), empty("missing_from_current_gp"),
        F.coalesce("_ids", F.array().cast("array<string>")).alias("present_in_current_gp_not_in_archive"), empty("reappeared_in_current_gp"),
    )
    states = both.select("date", "observed_at_utc", F.map_from_entries(F.transform(empty("_state"), lambda s: F.struct(s["norad_cat_id"].alias("key"), s.alias("value")))).alias("missing_objects"))
    return audit, states


def files(states: DataFrame, manifests: DataFrame, delta: DataFrame | None = None, audit: DataFrame | None = None, visibility: DataFrame | None = None, id_col: str = "object_id", record_col: str = "rec", date_col: str = "snapshot_date") -> DataFrame:
    """(date, name, text) of all artifacts: catalogs, each a value of at most 2 GB, and json_files(). sources.days writes larger catalogs from text_pieces()."""
    catalogs = catalog_texts(states, id_col, record_col, [date_col]).select(F.date_format(date_col, "yyyy-MM-dd").alias("date"), F.lit("catalog.json.gz").alias("name"), "text")
    return catalogs.unionByName(json_files(manifests, delta, audit, visibility))


def json_files(manifests: DataFrame, delta: DataFrame | None = None, audit: DataFrame | None = None, visibility: DataFrame | None = None) -> DataFrame:
    """(date, name, text) of a day's artifacts besides the catalog, as JSON; manifests leave out what isn't set."""
    json = lambda df, name, nulls: df.select("date", F.lit(name).alias("name"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": nulls}).alias("text"))
    parts = [json(manifests, "manifest.json", "true")]
    parts += [json(df, name, "false") for df, name in ((delta, "delta.json"), (audit, "audit.json"), (visibility, "visibility_state.json")) if df is not None]
    return reduce(DataFrame.unionByName, parts)
