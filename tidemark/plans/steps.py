"""Queries over single steps: one window's pull, one day's snapshot and audit, keys of records, observations, bundles, hashes of any text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feed import EVENTS
from ..functions import scalars
from ..functions.canonical import canonical_text, record_hash
from ..operators import merge, rules, timeline, visibility, windows
from ..sources import archive, days
from ..sources.shared import new_path
from . import archives

BASE, DAY, NEXT = "2024-01-14", "2024-01-15", "2024-01-16"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which some have no object."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")))


_FEED_SQL = "feed as (select case when event_id % 7 <> 0 then user_id end as user_id, event_id, event_type, value, ts from events)"


def window_pull(spark, sf_dir):
    """The latest row of each object in a window of two days, with how many rows and objects it had; rows without an object only count."""
    found, counts = windows.pull(_events(spark, sf_dir), EVENTS, BASE, NEXT)
    n = counts.first()
    return found.select("user_id", "event_id", "event_type", F.lit(n["raw_rows"]).alias("raw_rows"), F.lit(n["objects"]).alias("objects"))


def build_day(spark, sf_dir):
    """One day's snapshot from the day before and the window between them."""
    rows = _events(spark, sf_dir)
    base = timeline.as_of(rows, EVENTS, F.lit(BASE).cast("timestamp_ntz"))
    return merge.build_snapshot(base, rows, EVENTS, BASE, DAY).select("user_id", "event_id", "value", "change")


def record_keys(spark, sf_dir):
    """Selection keys, dates, cutoffs and summaries of records whose fields are texts, some of them missing or no numbers."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    created = F.when(F.col("event_id") % 11 != 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    tie = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).when(F.col("event_id") % 5 == 1, F.concat(F.lit(" +"), "event_id", F.lit(" "))).otherwise(F.col("event_id").cast("string"))
    rows = rows.select("event_id", created.alias("created"), tie.alias("tie"), F.date_format("ts", "yyyy-MM-dd").alias("epoch"), F.col("user_id").cast("string").alias("user"), "event_type")
    rec = F.create_map(*[x for k, v in (("NORAD_CAT_ID", "user"), ("OBJECT_NAME", "event_type"), ("EPOCH", "epoch"), ("CREATION_DATE", "created"), ("GP_ID", "tie")) for x in (F.lit(k), F.col(v))])
    key, c = scalars.selection_key("created", "tie", "epoch"), scalars.compact(rec)
    date = scalars.parse_date("epoch")
    return rows.select(
        "event_id", key["created"].alias("key_created"), key["tie"].cast("long").alias("key_tie"), key["epoch"].alias("key_epoch"), scalars.date_text(scalars.previous_date(date)).alias("previous"),
        F.date_format(scalars.cutoff(date), "yyyy-MM-dd HH:mm:ss").alias("cutoff"), c["object_id"].alias("object_id"), c["object_name"].alias("object_name"), c["creation_date"].alias("creation_date"), c["tie"].alias("tie"),
    )


def observation_rows(spark, sf_dir):
    """One full observation of several, checked and in order of ids."""
    at = lambda t: timeline.as_of(_events(spark, sf_dir), EVENTS, F.lit(t).cast("timestamp_ntz")).withColumn("snapshot_date", F.lit(t))
    every = archives.catalog_records(at(BASE).unionByName(at(DAY))).withColumnRenamed("snapshot_date", "observed_at")
    found = archive.checked_observation(every, DAY, least=1)
    return found.select("object_id", F.col("rec")["GP_ID"].alias("gp_id"))


def audit_continued(spark, sf_dir):
    """A day's audit that goes on from the state the day before left in its artifact, in the present layout and in the older one."""
    _, states = archives._audits(spark, sf_dir, archives._states(spark, sf_dir))
    before = states.where(F.col("date") == "2024-01-19").select("missing_objects")
    now = before.select(F.to_json(F.struct("missing_objects")).alias("text"))
    flagged = F.transform_values("missing_objects", lambda k, v: v.withField("currently_missing_from_current_gp", F.lit(True)))
    present = F.transform_values(F.map_from_entries(F.transform(F.map_entries("missing_objects"), lambda e: F.struct(F.concat(F.lit("back-"), e["key"]).alias("key"), e["value"].alias("value")))), lambda k, v: v.withField("currently_missing_from_current_gp", F.lit(False)))
    older = before.select(F.to_json(F.struct(F.map_concat(flagged, present).alias("objects"))).alias("text"))
    archived = archives._states(spark, sf_dir).where("snapshot_date = date '2024-01-20'").select(F.col("user_id").cast("string").alias("object_id"))
    observed = archived.where((F.col("object_id").cast("long") + F.expr("dayofyear(date '2024-01-20') div 3")) % 5 != 0)
    out = []
    for layout, text in (("present", now), ("older", older)):
        state = text.select(F.explode(archive.previous_visibility("text")).alias("object_id", "s"))
        previous = state.select("object_id", F.col("s.first_missing_in_current_gp_audit").alias("first_missing"), F.col("s.consecutive_missing_audits").alias("missing_days"), F.col("s.last_seen_in_current_gp_audit").alias("last_seen"))
        found = visibility.audit_day(archived, observed, previous, "2024-01-20T06:00:00Z")
        out.append(found.select(F.lit(layout).alias("layout"), "object_id", "present", "reappeared", "missing_since", "first_missing", F.col("missing_days").cast("long").alias("missing_days")))
    return reduce(DataFrame.union, out)


def archive_dates(spark, sf_dir):
    """The days of an archive that a second run has added to and a third has written again."""
    root = new_path(spark, "archive")
    each = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).distinct()
    files = each.select("date", F.lit("manifest.json").alias("name"), F.to_json(F.struct("date")).alias("text"))
    days.write_days(files.where("substr(date, 9, 2) < '15'"), root)
    days.write_days(files.where("substr(date, 9, 2) >= '15'"), root)
    days.write_days(files.where("substr(date, 9, 2) = '01'").withColumn("name", F.lit("audit.json")), root)
    return days.visible(spark, root).where("name = 'manifest.json'").select("date").distinct()


def bundle_check(spark, sf_dir):
    """Bundles against the manifests of their days: hashes and counts that differ, and days without a manifest."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderkey").alias("k"))
    each = orders.groupBy("date").agg(F.count("*").alias("object_count"), F.sha2(F.max("k").cast("string"), 256).alias("sha256"), F.max("k").alias("k"))
    bundles = each.select("date", F.when(F.col("k") % 5 == 0, F.lit("other")).otherwise(F.col("sha256")).alias("catalog_sha256"), (F.col("object_count") + F.when(F.col("k") % 3 == 0, 1).otherwise(0)).alias("object_count"))
    return rules.bundle_problems(bundles, each.where("k % 7 <> 0"))


def text_hash(spark, sf_dir):
    """Canonical text and hash of whole documents in four languages, with marks that JSON escapes put in."""
    odd = F.concat(F.lit('\x01\x7f"\\/\U0001f600 é\t'), F.coalesce("text", F.lit("")))
    rec = F.create_map(F.lit("text"), odd, F.lit("é"), F.col("lang"), F.lit("a"), F.lit(None).cast("string"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("rec", rec)
    return docs.select("doc_id", F.length(canonical_text("rec")).cast("long").alias("characters"), record_hash("rec").alias("sha256"))


_ESCAPED = """array_to_string(list_transform(regexp_extract_all({}, '(?s).'), lambda c: case when c = '"' then '\\"' when c = '\\' then '\\\\' when c = chr(10) then '\\n' when c = chr(13) then '\\r' when c = chr(9) then '\\t' when c = chr(8) then '\\b' when c = chr(12) then '\\f'
    when unicode(c) > 65535 then printf('\\u%04x', 55296 + ((unicode(c) - 65536) >> 10)) || printf('\\u%04x', 56320 + ((unicode(c) - 65536) & 1023)) when unicode(c) < 32 or unicode(c) > 126 then printf('\\u%04x', unicode(c)) else c end), '')"""

ORACLES = {
    "window_pull": f"""with {_FEED_SQL}, w as (select * from feed where ts >= timestamp '{BASE}' and ts < timestamp '{NEXT}'), c as (select count(*) as raw_rows, count(distinct user_id) as objects from w)
      select user_id, event_id, event_type, raw_rows, objects from (select * from w where user_id is not null qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1) cross join c""",
    "build_day": f"""with {_FEED_SQL}, l as (select *, ts >= timestamp '{BASE}' as late from feed where user_id is not null and ts < timestamp '{DAY}' qualify row_number() over (partition by user_id, ts >= timestamp '{BASE}' order by ts desc, event_id desc) = 1)
      select coalesce(a.user_id, b.user_id) as user_id, coalesce(b.event_id, a.event_id) as event_id, coalesce(b.value, a.value) as value, case when b.user_id is null then 'carried' when a.user_id is null then 'new' else 'updated' end as change
      from (select * from l where not late) a full join (select * from l where late) b on a.user_id = b.user_id""",
    "record_keys": """with e as (select *, case when event_id % 11 <> 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') end as c, case when event_id % 5 = 0 then 'n/a' when event_id % 5 = 1 then ' +' || event_id || ' ' else cast(event_id as varchar) end as t, cast(ts as date) as d from events)
      select event_id, coalesce(c, '') as key_created, case when event_id % 5 = 0 then 0 else event_id end as key_tie, strftime(d, '%Y-%m-%d') as key_epoch, strftime(d - 1, '%Y-%m-%d') as previous, strftime(d, '%Y-%m-%d 00:00:00') as cutoff, cast(user_id as varchar) as object_id, event_type as object_name, c || 'Z' as creation_date, t as tie from e""",
    "observation_rows": f"""with {_FEED_SQL} select cast(user_id as varchar) as object_id, cast(event_id as varchar) as gp_id from feed where user_id is not null and ts < timestamp '{DAY}' qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "audit_continued": f"""with {archives._SIGHT_SQL} select layout, cast(user_id as varchar) as object_id, present, present and coalesce(was = false, false) as reappeared, case when present and was = false then missed end as missing_since, case when not present then since end as first_missing, case when not present then n end as missing_days
      from back cross join (values ('present'), ('older')) as t(layout) where d = date '2024-01-20'""",
    "archive_dates": "select distinct strftime(o_orderdate, '%Y-%m-%d') as date from orders where day(o_orderdate) <> 1",
    "bundle_check": """with d as (select strftime(o_orderdate, '%Y-%m-%d') as date, max(o_orderkey) as k from orders group by 1)
      select date, case when k % 7 = 0 then 'no manifest' when k % 5 = 0 then 'sha256' else 'object_count' end as problem from d where k % 7 = 0 or k % 5 = 0 or k % 3 = 0""",
    "text_hash": f"""with t as (select doc_id, '{{"a":null,"text":"' || {_ESCAPED.format("chr(1) || chr(127) || '" + chr(34) + chr(92) + "/' || chr(128512) || ' é' || chr(9) || coalesce(text, '')")} || '","' || '\\u00e9' || '":' || coalesce('"' || lang || '"', 'null') || '}}' as j from documents)
      select doc_id, length(j) as characters, sha256(j) as sha256 from t""",
}
QUERIES = {f.__name__: f for f in (window_pull, build_day, record_keys, observation_rows, audit_continued, archive_dates, bundle_check, text_hash)}
