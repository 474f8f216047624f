"""Queries over the driver tables, each with the SQL that gives the same rows.

events is read as a feed of revisions: user_id names the object, ts is the publication time, event_id decides between
rows of the same time. The observation of a day D sees the objects with (user_id + dayofyear(D) div 3) % 5 <> 0, and
two days have no audit. orders is a second, sparser feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feed import EVENTS, ORDERS, Feed
from ..functions.canonical import as_record, id_set_hash, record_hash, table_hash
from ..functions.scalars import date_spine, lenient_int, time_text, utc_stamp
from ..operators import compare, ledger, maintenance, merge, merkle, profile, rules, timeline, visibility, windows

BASE, DAY = "2024-01-14", "2024-01-15"
#: A base of the first day, and updates from the middle of that day to the end of the next, so that all kinds of change occur.
HELD, LOWER, UPPER = "2024-01-02", "2024-01-01 12:00:00", "2024-01-03"
FIRST, LAST = "2024-01-02", "2024-01-31"
NO_AUDIT = ("2024-01-10", "2024-01-17")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def text(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def records(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.col("user_id").cast("string").alias("object_id"), as_record(df, list(columns)).alias("rec"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.daily_states(timeline.versions(table(spark, sf_dir, "events"), EVENTS), FIRST, LAST)


# windows and merges


def window_filter(spark, sf_dir):
    rows = windows.in_window(table(spark, sf_dir, "events"), EVENTS, ntz("2024-01-10"), ntz("2024-01-12"))
    return rows.select("event_id", "user_id", "event_type", "value")


def dedupe_latest(spark, sf_dir):
    return windows.latest(table(spark, sf_dir, "events"), EVENTS).select("user_id", "event_id", "event_type", "value", "props")


def _changes(spark, sf_dir):
    """Events as they arrive, every fourth of them published three days before."""
    arrived = table(spark, sf_dir, "events").withColumn("created", F.expr("if(event_id % 4 = 0, ts - interval 3 days, ts)"))
    feed = Feed("user_id", "created", ("event_id",))
    base, updates = (windows.latest(windows.in_window(arrived, EVENTS, lo, ntz(hi)), feed) for lo, hi in ((None, HELD), (ntz(LOWER), UPPER)))
    return merge.apply_updates(base, updates, feed)


def apply_updates(spark, sf_dir):
    return _changes(spark, sf_dir).select("user_id", "event_id", "value", "change")


def delta_summary(spark, sf_dir):
    found = merge.delta_summary(_changes(spark, sf_dir), EVENTS)
    return found.select(*[c if not c.endswith("_ids") else F.array_join(c, ",").alias(c) for c in found.columns])


# timelines


def roll_forward_daily(spark, sf_dir):
    return timeline.daily_agreement(states(spark, sf_dir), EVENTS).select(text("snapshot_date"), "objects", "checksum")


def as_of_state(spark, sf_dir):
    return timeline.as_of(table(spark, sf_dir, "events"), EVENTS, ntz("2024-01-20")).select("user_id", "event_id", "value")


def order_versions(spark, sf_dir):
    found = timeline.versions(table(spark, sf_dir, "orders"), ORDERS)
    return found.select("o_custkey", "o_orderkey", text("valid_from"), text("valid_to"))


def replay_windows(spark, sf_dir):
    return timeline.replay_windows(table(spark, sf_dir, "events"), EVENTS, ntz("2024-01-01"), ntz("2024-01-25 12:00:00")).withColumn("window_date", text("window_date"))


def next_date(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    return timeline.next_date(days, "1998-12-01").select(text("next_date"))


def _urgent_days(spark, sf_dir):
    """The days on which a fifth of the orders or more are urgent."""
    each = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return each.where("date is not null and urgent * 5 >= n").select("date")


def date_gaps(spark, sf_dir):
    days = _urgent_days(spark, sf_dir)
    return date_spine(spark, "1992-01-01", "1998-12-01").join(days, "date", "left_anti").select(text("date"))


def latest_dates(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    return timeline.latest_dates(days, 10).select(text("date"))


# visibility


def _streaks(spark, sf_dir):
    archived = states(spark, sf_dir).select(F.col("snapshot_date").alias("date"), F.col("user_id").alias("object_id"))
    seen = archived.where((F.col("object_id") + F.expr("dayofyear(date) div 3")) % 5 != 0)
    audits = date_spine(spark, FIRST, LAST).where(~F.date_format("date", "yyyy-MM-dd").isin(*NO_AUDIT)).withColumn("observed_at", F.date_format("date", "yyyy-MM-dd'T06:00:00Z'"))
    return visibility.streaks(archived, seen, audits)


def visibility_missing(spark, sf_dir):
    return _streaks(spark, sf_dir).where("not present").select(text("date"), "object_id", "missing_days", "first_missing")


def visibility_reappeared(spark, sf_dir):
    return _streaks(spark, sf_dir).where("reappeared").select(text("date"), "object_id", "missing_since")


def visibility_unknown(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    observed = events.select(F.to_date("ts").alias("date"), "user_id").distinct()
    archived = events.where("event_type <> 'purchase'").select(F.to_date("ts").alias("date"), "user_id").distinct()
    return visibility.unknown(observed, archived, ["date", "user_id"]).select(text("date"), "user_id")


def present_ids_hash(spark, sf_dir):
    found = id_set_hash(table(spark, sf_dir, "events").withColumn("date", F.to_date("ts")), "user_id", ["date"])
    return found.select(text("date"), F.col("ids").cast("long"), "sha256")


# hashes and comparison


def row_hash(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", record_hash(as_record(events, ["event_id", "user_id", "event_type", "props"])).alias("sha256"))


def table_hash_daily(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = events.select(F.to_date("ts").alias("date"), "event_id", as_record(events, ["event_id", "event_type", "user_id"]).alias("rec"))
    found = table_hash(rows, "event_id", "rec", ["date"])
    return found.select(text("date"), F.col("objects").cast("long"), F.col("raw_bytes").cast("long"), "sha256")


def _aligned(spark, sf_dir):
    now = windows.latest(table(spark, sf_dir, "events"), EVENTS)
    other = now.where("user_id % 11 <> 0").withColumn("event_type", F.expr("if(user_id % 5 = 0, upper(event_type), event_type)")).withColumn("props", F.expr("if(user_id % 10 = 0, null, props)"))
    columns = ("event_id", "event_type", "props")
    return compare.align(records(now.where("user_id % 13 <> 0"), *columns), records(other, *columns))


def compare_sets(spark, sf_dir):
    return compare.compare_counts(_aligned(spark, sf_dir))


def compare_sample(spark, sf_dir):
    return compare.sample(_aligned(spark, sf_dir), compare.MISMATCHED).select("object_id", "status")


def field_diff(spark, sf_dir):
    found = compare.field_diff(_aligned(spark, sf_dir))
    return found.select("object_id", F.array_join("differing_fields", ",").alias("fields"), F.col("differing_field_count").cast("long").alias("n"))


def daily_diff(spark, sf_dir):
    both = [records(timeline.as_of(table(spark, sf_dir, "events"), EVENTS, ntz(d)), "event_id", "event_type", "props") for d in (BASE, DAY)]
    return profile.daily_diff(*both).select("object_id", F.array_join("differing_fields", ",").alias("fields"))


def lookup_observed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    wanted = windows.in_window(events, EVENTS, ntz("2024-01-29")).where("value > 150").select("user_id")
    return compare.lookup(wanted, windows.latest(events, EVENTS), "user_id").select("user_id", "event_id")


def time_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("z", utc_stamp("ts"))
    return events.select("event_id", time_text("z").alias("created"), lenient_int(F.expr("case event_id % 4 when 0 then ' 12 ' when 1 then '1.5' when 2 then '-7' end")).cast("long").alias("n"))


# ledgers and rules


def _manifests(spark, sf_dir):
    days = timeline.daily_agreement(states(spark, sf_dir), EVENTS)
    sha = F.sha2(F.concat_ws("|", text("snapshot_date"), "objects", "checksum").cast("binary"), 256)
    return days.select(text("snapshot_date").alias("date"), sha.alias("sha256"), F.col("objects").alias("object_count"), (F.col("objects") * 10).alias("compressed_bytes"), F.lit(ledger.ROLLING).alias("provenance"), F.lit("ranges").alias("query_strategy"), F.concat(text("snapshot_date"), F.lit("T00:10:00Z")).alias("archived_at"))


MANIFESTS_SQL = """
versions as (select user_id, event_id, cast(ts as date) + 1 as d, row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as r from events),
firsts as (select user_id, event_id, d, coalesce(lead(d) over (partition by user_id order by d) - 1, date '2024-01-31') as z from versions where r = 1),
days as (select cast(unnest(generate_series(date '2024-01-02', date '2024-01-31', interval 1 day)) as date) as snapshot_date),
daily as (select snapshot_date, count(*) as objects, cast(sum(event_id) as bigint) as checksum from days join firsts on snapshot_date between d and z group by 1),
manifests as (select strftime(snapshot_date, '%Y-%m-%d') as date, sha256(strftime(snapshot_date, '%Y-%m-%d') || '|' || objects || '|' || checksum) as sha256, objects as object_count, objects * 10 as compressed_bytes,
  'rolling_gp_history_delta' as provenance, 'ranges' as query_strategy, strftime(snapshot_date, '%Y-%m-%d') || 'T00:10:00Z' as archived_at from daily)
"""


def ledger_upsert(spark, sf_dir):
    found = ledger.entries(_manifests(spark, sf_dir))
    old = found.where("date < '2024-01-20'").withColumn("sha256", F.expr("if(day(date) % 4 = 0, md5(date), sha256)"))
    new = found.where("date >= '2024-01-10'")
    merged = ledger.upsert(old, new, "2024-02-01T00:00:00Z")
    return merged.select("date", "sha256", "object_count", "previous_sha256", "regenerated_at")


def _linked(spark, sf_dir):
    chained = ledger.chain_hash(_manifests(spark, sf_dir), "date").withColumn("base_snapshot_date", F.expr("lag(date) over (order by date)"))
    return chained.withColumn("base_snapshot_sha256", F.expr("if(day(date) % 9 = 0, 'x', base_sha256)")).where("day(date) % 8 <> 0")


def ledger_chain(spark, sf_dir):
    return ledger.broken_links(_linked(spark, sf_dir)).select("date", "rule")


def ledger_fields(spark, sf_dir):
    found = ledger.entries(_manifests(spark, sf_dir))
    off = found.withColumn("object_count", F.expr("if(day(date) % 6 = 0, object_count + 1, object_count)")).withColumn("query_strategy", F.expr("if(day(date) % 10 = 0, null, query_strategy)"))
    return ledger.field_differences(off, _manifests(spark, sf_dir)).withColumn("ledger_value", F.coalesce("ledger_value", F.lit("")))


def archive_rules(spark, sf_dir):
    m = _linked(spark, sf_dir).withColumn("day", F.day("date")).withColumn("facts", F.struct(F.lit(True).alias("readable"), F.expr("if(day % 5 = 0, 'y', sha256)").alias("sha256"), (F.col("object_count") * 100).alias("raw_bytes"), (F.col("day") % 7 != 0).alias("canonical"), F.expr("object_count + if(day % 11 = 0, 1, 0)").alias("objects"), (F.col("day") == 12).alias("repeats"), (F.col("day") != 13).alias("ordered"), F.lit(False).alias("incomplete")))
    manifest = F.struct("date", "sha256", "object_count", (F.col("object_count") * 100).alias("raw_bytes"), "compressed_bytes", "provenance", F.col("base_snapshot_date").alias("delta_window_start_utc"), F.col("date").alias("delta_window_end_utc"))
    ids = lambda n: F.expr(f"transform(sequence(1, {n}), i -> cast(i as string))")
    delta = F.struct("date", F.col("base_snapshot_date").alias("window_start_utc"), F.expr("if(day = 14, 'z', date)").alias("window_end_utc"), F.lit(6).cast("long").alias("deduped_update_count"), F.lit(1).cast("long").alias("new_object_count"), F.lit(2).cast("long").alias("updated_object_count"), F.lit(2).cast("long").alias("unchanged_update_count"), F.expr("if(day = 15, 2L, 1L)").alias("ignored_older_update_count"), ids(1).alias("new_norad_cat_ids"), ids(2).alias("updated_norad_cat_ids"), ids(2).alias("unchanged_update_norad_cat_ids"), ids(1).alias("ignored_older_update_norad_cat_ids"))
    nothing = lambda kind: F.lit(None).cast(kind)
    from ..schema import AUDIT, VISIBILITY

    shape = lambda s: f"struct<{s}>"
    days = m.select("date", manifest.alias("manifest"), F.lit(False).alias("manifest_broken"), F.when(F.col("day") != 16, F.col("facts")).alias("catalog"), F.col("compressed_bytes"), F.when(F.col("day") != 17, delta).alias("delta"), F.lit(False).alias("delta_broken"), nothing(shape(AUDIT)).alias("audit"), F.lit(False).alias("audit_broken"), nothing(shape(VISIBILITY)).alias("visibility"), F.lit(False).alias("visibility_broken"))
    return rules.day_violations(days, least=1, latest_catalogs=30).select("date", "rule")


def validate_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    full = as_record(events, ["user_id", "event_type", "value"])
    rec = F.map_filter(full, lambda k, v: ~(((k == "value") & (F.col("event_id") % 7 == 0)) | ((k == "event_type") & (F.col("event_id") % 11 == 0))))
    found = rules.invalid_records(events.select("event_id", rec.alias("rec")), "event_id", "rec", ("user_id", "event_type", "value"))
    return found.select("event_id", F.array_join("missing_fields", ",").alias("missing"))


def verify_dates(spark, sf_dir):
    found = _manifests(spark, sf_dir)
    return rules.verify_hashes(found.select("date", F.expr("if(day(date) % 6 = 1, md5(date), sha256)").alias("sha256")), found).select("date", "status")


# upkeep


def retention_plan(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    bundled = days.where("day(date) % 3 <> 0")
    return maintenance.retention(days, 100, bundled).select(text("date"), "action")


def restore_plan(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return maintenance.status_counts(maintenance.restore(days, days.where("date like '%-1%'"), start="1994-01-01", end="1995-12-31"))


def _receipts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.concat(F.lit("d"), F.col("o_custkey") % 3).alias("destination"), F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("bundle_sha256"), F.col("o_orderkey").alias("updated_at"))
    return orders.where("updated_at % 2 = 0"), orders.where("updated_at % 2 = 1")


def receipt_merge(spark, sf_dir):
    return maintenance.merge_receipts(*_receipts(spark, sf_dir))


def publish_plan(spark, sf_dir):
    merged = maintenance.merge_receipts(*_receipts(spark, sf_dir))
    bundles = merged.groupBy("date").agg(F.max_by("bundle_sha256", "updated_at").alias("bundle_sha256"))
    return maintenance.publish_ledgered(bundles, merged, "d1")


def write_plan(spark, sf_dir):
    days = date_spine(spark, "1998-01-01", "1998-12-31").select(text("date"))
    return maintenance.to_write(days, _urgent_days(spark, sf_dir).select(text("date")))


# analyses


def id_gaps(spark, sf_dir):
    return profile.id_gaps(table(spark, sf_dir, "lineitem"), "l_orderkey", bucket=10_000)


def field_profile(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rec = events.withColumn("event_type", F.expr("if(event_id % 9 = 0, '', event_type)")).withColumn("source", F.lit("feed"))
    return profile.field_profile(rec.select(as_record(rec, ["event_id", "event_type", "props", "source"]).alias("rec")))


def top_values(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return profile.top_values(events.select(as_record(events, ["event_type", "props", "user_id"]).alias("rec")), 5).withColumn("rank", F.col("rank").cast("long"))


def agreement(spark, sf_dir):
    days = _manifests(spark, sf_dir)
    archives = None
    for k, name in enumerate(("a", "b", "c")):
        one = days.select(F.lit(name).alias("archive"), "date", F.expr(f"if({k} = 2 and day(date) % 10 = 0, md5(date), sha256)").alias("sha256"), "object_count")
        archives = one if archives is None else archives.unionByName(one)
    return profile.agreement(archives)


def hourly_budget(spark, sf_dir):
    uses = table(spark, sf_dir, "events").select(F.col("event_type").alias("signer"), F.col("ts").alias("at"), F.col("event_id").alias("cost"), "event_id")
    return profile.hourly_budget(uses.select("signer", "at", F.col("cost").cast("long"), "event_id"), 50_000).select("event_id", "spent", "within")


def daily_quota(spark, sf_dir):
    uses = table(spark, sf_dir, "events").select(F.col("user_id").alias("signer"), F.col("event_type").alias("chain"), F.struct("ts", "event_id").alias("k"), F.col("ts").alias("at"), "event_id")
    quotas = uses.groupBy("signer").agg((F.col("signer") % 4).alias("holdings"), F.col("signer") % 5).toDF("signer", "holdings", "score")
    return profile.within_quota(uses.drop("k"), quotas, 2).groupBy("signer").agg(F.count_if("allowed").alias("allowed"), F.count("*").alias("uses"))


def recent_overlay(spark, sf_dir):
    """The index has every block up to a day; the events after it are laid over it."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("block"), "event_type", "ts")
    indexed = events.agg(F.max(F.when(F.col("ts") < ntz("2024-01-20"), F.col("block")))).first()[0] or 0
    events = events.drop("ts")
    index = events.where(F.col("block") <= indexed).groupBy("user_id").agg(F.max_by("event_type", "block").alias("event_type"), F.max("block").alias("block")).select("user_id", "block", "event_type")
    return profile.overlay(index, events, "user_id", indexed).select("user_id", "block", "event_type", "stale")


def merkle_roots(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "utf-8").alias("content"))
    return merkle.roots(merkle.chunks(docs, size=4096, least=512))


def stream_daily_latest(spark, sf_dir):
    from ..sources.shared import new_path
    from ..streaming.daily import run_daily

    out = new_path(spark, "stream")
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    query = run_daily(stream, EVENTS, f"{out}/days", f"{out}/log")
    query.awaitTermination()
    days = spark.read.schema("user_id bigint, event_id bigint, window_date date").parquet(f"{out}/days")
    return days.select(text("window_date"), "user_id", "event_id")


_URGENT_SQL = "(select cast(o_orderdate as date) as d from orders where o_orderdate is not null group by 1 having count(*) filter (o_orderpriority = '1-URGENT') * 5 >= count(*))"

ORACLES = {
    "window_filter": "select event_id, user_id, event_type, value from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-12'",
    "dedupe_latest": "select user_id, event_id, event_type, value, props from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
    "order_versions": """
        with d as (select o_custkey, o_orderkey, cast(o_orderdate as date) + 1 as v from orders where o_custkey is not null
                   qualify row_number() over (partition by o_custkey, cast(o_orderdate as date) order by o_orderdate desc, o_orderkey desc) = 1)
        select o_custkey, o_orderkey, strftime(v, '%Y-%m-%d') as valid_from, strftime(lead(v) over (partition by o_custkey order by v), '%Y-%m-%d') as valid_to from d""",
    "as_of_state": "select user_id, event_id, value from events where ts < timestamp '2024-01-20' qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
    "replay_windows": """
        with w as (select cast(ts as date) as d, user_id from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-25 12:00:00'),
        f as (select user_id, min(d) as d from w group by 1),
        c as (select d, count(*) as raw_rows, count(distinct user_id) as deduped from w group by 1),
        n as (select d, count(*) as n from f group by 1)
        select strftime(c.d, '%Y-%m-%d') as window_date, raw_rows, deduped, deduped as applied, cast(0 as bigint) as ignored,
          cast(sum(coalesce(n, 0)) over (order by c.d) - coalesce(n, 0) as bigint) as objects_before, cast(sum(coalesce(n, 0)) over (order by c.d) as bigint) as objects_after
        from c left join n using (d)""",
    "next_date": "select strftime(least(max(cast(o_orderdate as date)) + 1, date '1998-12-01'), '%Y-%m-%d') as next_date from orders",
    "date_gaps": f"""
        select strftime(d, '%Y-%m-%d') as date from (select cast(unnest(generate_series(date '1992-01-01', date '1998-12-01', interval 1 day)) as date) as d)
        where d not in {_URGENT_SQL}""",
    "latest_dates": "select strftime(d, '%Y-%m-%d') as date from (select distinct cast(o_orderdate as date) as d from orders order by d desc limit 10)",
    "visibility_unknown": """
        select distinct strftime(cast(ts as date), '%Y-%m-%d') as date, user_id from events e
        where not exists (select 1 from events o where o.user_id = e.user_id and cast(o.ts as date) = cast(e.ts as date) and o.event_type <> 'purchase')""",
    "present_ids_hash": """
        with o as (select distinct cast(ts as date) as d, user_id from events)
        select strftime(d, '%Y-%m-%d') as date, count(*) as ids, sha256(string_agg(cast(user_id as varchar), chr(10) order by user_id)) as sha256 from o group by d""",
    "row_hash": """
        select event_id, sha256('{"event_id":"' || event_id || '","event_type":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '","user_id":"' || user_id || '"}') as sha256 from events""",
    "table_hash_daily": """
        with c as (select cast(ts as date) as d, '[' || string_agg('{"event_id":"' || event_id || '","event_type":"' || event_type || '","user_id":"' || user_id || '"}', ',' order by event_id) || ']' as t, count(*) as n from events group by 1)
        select strftime(d, '%Y-%m-%d') as date, n as objects, cast(strlen(t) as bigint) as raw_bytes, sha256(t) as sha256 from c""",
    "daily_diff": """
        with a as (select * from events where ts < timestamp '2024-01-14' qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
        b as (select * from events where ts < timestamp '2024-01-15' qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
        select cast(user_id as varchar) as object_id, concat_ws(',', case when a.event_id <> b.event_id then 'event_id' end, case when a.event_type <> b.event_type then 'event_type' end, case when a.props <> b.props then 'props' end) as fields
        from a join b using (user_id) where a.event_id <> b.event_id""",
    "lookup_observed": """
        select user_id, event_id from (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
        where user_id in (select user_id from events where ts >= timestamp '2024-01-29' and value > 150)""",
    "time_keys": "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as created, cast(case event_id % 4 when 0 then 12 when 2 then -7 else 0 end as bigint) as n from events",
    "validate_rows": """
        select event_id, concat_ws(',', case when event_id % 11 = 0 then 'event_type' end, case when event_id % 7 = 0 then 'value' end) as missing from events where event_id % 11 = 0 or event_id % 7 = 0""",
    "retention_plan": """
        with d as (select cast(o_orderdate as date) as d from orders group by 1), r as (select d, row_number() over (order by d desc) as r from d)
        select strftime(d, '%Y-%m-%d') as date, case when r <= 100 then 'retained' when day(d) % 3 = 0 then 'skipped' else 'pruned' end as action from r""",
    "restore_plan": """
        with d as (select distinct strftime(o_orderdate, '%Y-%m-%d') as d from orders where o_orderdate >= timestamp '1994-01-01' and o_orderdate < timestamp '1996-01-01')
        select case when d like '%-1%' then 'present' else 'restore' end as action, count(*) as n from d group by 1""",
    "receipt_merge": """
        select strftime(o_orderdate, '%Y-%m-%d') as date, 'd' || (o_custkey % 3) as destination, md5(cast(o_orderkey as varchar)) as bundle_sha256, o_orderkey as updated_at from orders
        qualify row_number() over (partition by strftime(o_orderdate, '%Y-%m-%d'), o_custkey % 3 order by o_orderkey desc) = 1""",
    "publish_plan": """
        with m as (select strftime(o_orderdate, '%Y-%m-%d') as date, o_custkey % 3 as d, max(o_orderkey) as k from orders group by 1, 2),
        b as (select date, max(k) as k from m group by 1)
        select b.date, case when m.k = b.k then 'skipped' else 'uploaded' end as status from b left join m on m.date = b.date and m.d = 1""",
    "write_plan": f"""
        select strftime(d, '%Y-%m-%d') as date from (select cast(unnest(generate_series(date '1998-01-01', date '1998-12-31', interval 1 day)) as date) as d)
        where d not in {_URGENT_SQL}""",
    "id_gaps": """
        with i as (select distinct l_orderkey as i from lineitem), n as (select i, lead(i) over (order by i) as n from i),
        g as (select i, n, n - i - 1 as size from n where n > i + 1 order by size desc, i limit 1),
        s as (select count(*) as present, min(i) as lowest, max(i) as highest from i)
        select present, lowest, highest, highest - lowest + 1 as span, highest - lowest + 1 - present as missing, round(present / (highest - lowest + 1), 6) as density,
          coalesce(g.size, 0) as largest_gap, g.i + 1 as gap_from, g.n - 1 as gap_to from s left join g on true""",
    "field_profile": """
        with f as (select unnest(['event_id', 'event_type', 'props', 'source']) as field, unnest([cast(event_id as varchar), case when event_id % 9 = 0 then '' else event_type end, props, 'feed']) as v from events)
        select field, count(*) as records, count(*) filter (v is null or v = '') as blanks, count(distinct nullif(v, '')) as distinct, min(nullif(v, '')) as smallest, max(nullif(v, '')) as largest, count(distinct nullif(v, '')) <= 1 as constant from f group by 1""",
    "top_values": """
        with f as (select unnest(['event_type', 'props', 'user_id']) as field, unnest([event_type, props, cast(user_id as varchar)]) as value from events),
        c as (select field, value, count(*) as count from f where value is not null group by 1, 2)
        select field, row_number() over (partition by field order by count desc, value) as rank, value, count from c qualify row_number() over (partition by field order by count desc, value) <= 5""",
    "hourly_budget": """
        with s as (select event_id, cast(sum(event_id) over (partition by event_type order by ts range between interval 1 hour preceding and current row) as bigint) as spent from events)
        select event_id, spent, spent <= 50000 as within from s""",
    "daily_quota": """
        with r as (select user_id, row_number() over (partition by user_id, event_type, cast(ts as date) order by ts) as r from events)
        select user_id as signer, count(*) filter (r <= case when user_id % 5 > 0 then least(user_id % 4, 2) else 0 end) as allowed, count(*) as uses from r group by 1""",
    "recent_overlay": "select user_id, event_id as block, event_type, false as stale from events qualify row_number() over (partition by user_id order by event_id desc) = 1",
    "stream_daily_latest": """
        select strftime(cast(ts as date), '%Y-%m-%d') as window_date, user_id, event_id from events where cast(ts as date) < (select cast(max(ts) as date) from events)
        qualify row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) = 1""",
}

_CHANGES_SQL = f"""
a as (select *, case when event_id % 4 = 0 then ts - interval 3 days else ts end as created from events),
b as (select * from a where ts < timestamp '{HELD}' qualify row_number() over (partition by user_id order by created desc, event_id desc) = 1),
u as (select * from a where ts >= timestamp '{LOWER}' and ts < timestamp '{UPPER}' qualify row_number() over (partition by user_id order by created desc, event_id desc) = 1),
c as (select user_id, case when u.user_id is null then 'carried' when b.user_id is null then 'new' when (u.created, u.event_id) > (b.created, b.event_id) then 'updated' when u.event_id = b.event_id then 'unchanged' else 'ignored_older' end as change,
  b.event_id as be, u.event_id as ue, b.value as bv, u.value as uv from b full join u using (user_id))
"""
_ids = lambda kind: f"coalesce(string_agg(cast(user_id as varchar), ',' order by user_id) filter (change = '{kind}'), '') as {kind}_ids"
ORACLES["apply_updates"] = f"with {_CHANGES_SQL} select user_id, case when change in ('new', 'updated') then ue else be end as event_id, case when change in ('new', 'updated') then uv else bv end as value, change from c"
ORACLES["delta_summary"] = f"""with {_CHANGES_SQL} select count(*) filter (change <> 'carried') as deduped_count, {', '.join(f"count(*) filter (change = '{k}') as {k}_count" for k in ("new", "updated", "unchanged", "ignored_older", "carried"))},
  {', '.join(map(_ids, ("new", "updated", "unchanged", "ignored_older")))} from c"""
ORACLES["roll_forward_daily"] = f"with {MANIFESTS_SQL} select strftime(snapshot_date, '%Y-%m-%d') as snapshot_date, objects, checksum from daily"
ORACLES["ledger_upsert"] = f"""with {MANIFESTS_SQL}, o as (select date, case when day(cast(date as date)) % 4 = 0 then md5(date) else sha256 end as old from manifests where date < '2024-01-20')
  select m.date, case when m.date < '2024-01-10' then old else m.sha256 end as sha256, object_count, case when m.date >= '2024-01-10' and old <> m.sha256 then old end as previous_sha256,
  case when m.date >= '2024-01-10' and old <> m.sha256 then '2024-02-01T00:00:00Z' end as regenerated_at from manifests m left join o using (date)"""
_LINKED_SQL = f"""{MANIFESTS_SQL}, chained as (select *, day(cast(date as date)) as day, lag(date) over (order by date) as base_date, lag(sha256) over (order by date) as base_sha from manifests),
  linked as (select * exclude (base_sha), case when day % 9 = 0 then 'x' else base_sha end as base_sha from chained where day % 8 <> 0)"""
ORACLES["ledger_chain"] = f"""with {_LINKED_SQL} select l.date, case when b.date is null then 'L09' else 'L10' end as rule from linked l left join linked b on b.date = l.base_date
  where b.date is null or b.sha256 is distinct from l.base_sha"""
ORACLES["ledger_fields"] = f"""with {MANIFESTS_SQL} select date, 'object_count' as field, cast(object_count + 1 as varchar) as ledger_value, cast(object_count as varchar) as manifest_value from manifests where day(cast(date as date)) % 6 = 0
  union all select date, 'query_strategy', '', query_strategy from manifests where day(cast(date as date)) % 10 = 0"""
ORACLES["archive_rules"] = f"""with {_LINKED_SQL} select date, unnest(list_filter([case when day % 5 = 0 and day <> 16 then 'R05' end, case when day % 7 = 0 and day <> 16 then 'R06' end, case when day % 11 = 0 then 'R09' end, case when day = 12 then 'R11' end,
  case when day = 13 then 'R12' end, case when day = 16 then 'R13' end, case when day = 17 then 'R15' end, case when day = 14 then 'R19' end, case when day = 15 then 'R23' end, case when day = 15 then 'R24' end], lambda x: x is not null)) as rule from linked"""
ORACLES["verify_dates"] = f"with {MANIFESTS_SQL} select date, case when day(cast(date as date)) % 6 = 1 then 'MISMATCH' else 'VERIFIED' end as status from manifests"
ORACLES["agreement"] = f"""with {MANIFESTS_SQL} select date, cast(3 as bigint) as archives, cast(case when day(cast(date as date)) % 10 = 0 then 2 else 1 end as bigint) as hashes, sha256 as common_sha256,
  cast(case when day(cast(date as date)) % 10 = 0 then 2 else 3 end as bigint) as agreeing, day(cast(date as date)) % 10 <> 0 as agreed from manifests"""
_STREAK_SQL = """with first_day as (select user_id as object_id, min(cast(ts as date)) + 1 as f from events group by 1),
days as (select cast(unnest(generate_series(date '2024-01-02', date '2024-01-31', interval 1 day)) as date) as d),
grid as (select d, object_id, case when strftime(d, '%Y-%m-%d') in ('2024-01-10', '2024-01-17') then null else (object_id + dayofyear(d) // 3) % 5 <> 0 end as present from days join first_day on d >= f),
runs as (select *, sum(case when present is distinct from false then 1 else 0 end) over (partition by object_id order by d) as run from grid),
found as (select *, count(*) filter (present = false) over (partition by object_id, run order by d) as missing_days, min(case when present = false then strftime(d, '%Y-%m-%d') || 'T06:00:00Z' end) over (partition by object_id, run order by d) as first_missing from runs),
back as (select *, lag(present) over (partition by object_id order by d) as before, lag(first_missing) over (partition by object_id order by d) as since from found)
"""
ORACLES["visibility_missing"] = _STREAK_SQL + "select strftime(d, '%Y-%m-%d') as date, object_id, missing_days, first_missing from back where present = false"
ORACLES["visibility_reappeared"] = _STREAK_SQL + "select strftime(d, '%Y-%m-%d') as date, object_id, since as missing_since from back where present and before = false"
_ALIGNED_SQL = """with n as (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
l as (select user_id, event_type, props from n where user_id % 13 <> 0),
r as (select user_id, case when user_id % 5 = 0 then upper(event_type) else event_type end as event_type, case when user_id % 10 = 0 then null else props end as props from n where user_id % 11 <> 0),
a as (select user_id, l.user_id is not null as il, r.user_id is not null as ir, l.event_type is distinct from r.event_type as t, l.props is distinct from r.props as p from l full join r using (user_id))
"""
ORACLES["compare_sets"] = _ALIGNED_SQL + """select count(*) filter (il) as left_count, count(*) filter (ir) as right_count, count(*) filter (il and ir) as shared_count, count(*) filter (il and ir and not (t or p)) as matched_count,
  count(*) filter (il and ir and (t or p)) as mismatched_count, count(*) filter (il and not ir) as only_left_count, count(*) filter (ir and not il) as only_right_count from a"""
ORACLES["compare_sample"] = _ALIGNED_SQL + "select cast(user_id as varchar) as object_id, 'mismatched' as status from a where il and ir and (t or p) order by user_id limit 25"
ORACLES["field_diff"] = _ALIGNED_SQL + "select cast(user_id as varchar) as object_id, concat_ws(',', case when t then 'event_type' end, case when p then 'props' end) as fields, cast(t as bigint) + cast(p as bigint) as n from a where il and ir and (t or p)"

QUERIES = {
    f.__name__: f
    for f in (
        window_filter, dedupe_latest, apply_updates, delta_summary, roll_forward_daily, as_of_state, order_versions, replay_windows, next_date, date_gaps, latest_dates,
        visibility_missing, visibility_reappeared, visibility_unknown, present_ids_hash, row_hash, table_hash_daily, compare_sets, compare_sample, field_diff, daily_diff, lookup_observed, time_keys,
        ledger_upsert, ledger_chain, ledger_fields, archive_rules, validate_rows, verify_dates, retention_plan, restore_plan, receipt_merge, publish_plan, write_plan,
        id_gaps, field_profile, top_values, agreement, hourly_budget, daily_quota, recent_overlay, merkle_roots, stream_daily_latest,
    )
}
