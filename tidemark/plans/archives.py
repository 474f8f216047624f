"""Queries over whole daily archives: artifacts as they are built, written as files, read back and audited."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feed import EVENTS, Feed
from ..functions.canonical import as_record, text_pieces
from ..functions.scalars import date_spine
from ..operators import artifacts, maintenance, merkle, profile, rules, timeline, visibility
from ..sources import archive, catalogs, days, files
from ..sources.shared import new_path, stored

FIRST, LAST = "2024-01-02", "2024-02-15"
GENESIS_AT, VERSION, STRATEGY, ARCHIVED = "2024-01-02T06:00:00Z", "1", "ranges", "2024-03-01T00:00:00Z"
#: Records have every required field; what events don't have is filled with the event's number.
FILLED = ("MEAN_MOTION", "ECCENTRICITY", "INCLINATION", "RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def catalog_records(states: DataFrame) -> DataFrame:
    """(snapshot_date, object_id, rec) of daily states of events."""
    named = states.select("snapshot_date", F.col("user_id").cast("string").alias("object_id"), F.col("user_id").alias("NORAD_CAT_ID"), F.col("event_type").alias("OBJECT_NAME"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("CREATION_DATE"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("EPOCH"), F.col("event_id").alias("GP_ID"), *[F.col("event_id").alias(f) for f in FILLED])
    return named.select("snapshot_date", "object_id", as_record(named, ["NORAD_CAT_ID", "OBJECT_NAME", "CREATION_DATE", "EPOCH", "GP_ID", *FILLED]).alias("rec"))


def _base(spark, sf_dir):
    """The genesis: what was there at the time of the first observation."""
    return timeline.as_of(events(spark, sf_dir), EVENTS, F.lit(GENESIS_AT[:-1]).cast("timestamp_ntz"))


def _states(spark, sf_dir):
    at = F.lit(GENESIS_AT[:-1]).cast("timestamp_ntz")
    return timeline.daily_states(timeline.versions(events(spark, sf_dir), EVENTS, _base(spark, sf_dir), FIRST, at), FIRST, LAST)


def _manifests(spark, sf_dir):
    return archive.manifests(catalog_records(_states(spark, sf_dir)), archived_at=ARCHIVED, strategy=STRATEGY, version=VERSION, genesis_at=GENESIS_AT)


def manifest_full(spark, sf_dir):
    return _manifests(spark, sf_dir)


def _late(spark, sf_dir):
    """Events as they arrive: every fourth was published three days before, every fifth arrives again a day later."""
    rows = events(spark, sf_dir).withColumn("created", F.expr("if(event_id % 4 = 0, ts - interval 3 days, ts)"))
    return rows.union(rows.where("event_id % 5 = 0").withColumn("ts", F.expr("ts + interval 1 day")))


LATE = Feed("user_id", "created", ("event_id",))
_LATE_SQL = """late as (select user_id, event_id, ts, case when event_id % 4 = 0 then ts - interval 3 days else ts end as created from events),
  arrivals as (select * from late union all select user_id, event_id, ts + interval 1 day, created from late where event_id % 5 = 0),
  best as (select user_id, cast(ts as date) as d, count(*) as raw_rows, max(strftime(created, '%Y%m%d%H%M%S%f') || lpad(cast(event_id as varchar), 12, '0')) as k from arrivals group by 1, 2),
  ranked as (select *, max(k) over (partition by user_id order by d rows between unbounded preceding and 1 preceding) as m from best),
  changes as (select *, case when m is null then 'new' when k > m then 'updated' when k = m then 'unchanged' else 'ignored_older' end as change from ranked)"""


def replay_late(spark, sf_dir):
    found = timeline.replay_windows(_late(spark, sf_dir), LATE, None, None, "ts")
    return found.withColumn("window_date", day("window_date"))


def delta_artifact(spark, sf_dir):
    changes = timeline.daily_changes(_late(spark, sf_dir), LATE, arrived="ts")
    days = date_spine(spark, FIRST, "2024-02-05").select(day("date")).withColumn("delta_window_end_utc", F.concat("date", F.lit("T00:00:00Z")))
    held = timeline.replay_windows(_late(spark, sf_dir), LATE, None, None, "ts").select(F.date_format(F.date_add("window_date", 1), "yyyy-MM-dd").alias("date"), F.col("objects_after").alias("object_count"))
    last = F.expr("last(object_count, true) over (order by date)")  # one row for each day
    days = days.join(held, "date", "left").withColumn("object_count", last).withColumn("delta_window_start_utc", F.expr("lag(delta_window_end_utc) over (order by date)"))
    found = artifacts.deltas(changes, days, "user_id")
    return found.select(*[F.array_join(c, ",").alias(c) if c.endswith("_ids") else c for c in found.columns])


def _audits(spark, sf_dir, states):
    """Every day is audited at six; what an observation sees follows a rule, and some of it isn't archived."""
    archived = states.select(day("snapshot_date").alias("date"), F.col("user_id").alias("object_id"), F.col("event_type").alias("object_name"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created"))
    sight = (F.col("object_id") + F.expr("dayofyear(date) div 3")) % 5 != 0
    observed = archived.where(sight).select("date", "object_id").union(archived.where("object_id % 9 = 0").select("date", F.col("object_id") + 1_000_000_000))
    times = date_spine(spark, FIRST, LAST).select(day("date")).withColumn("observed_at", F.concat("date", F.lit("T06:00:00Z")))
    streaks = visibility.streaks(archived, observed, times)
    return artifacts.audits(streaks, archived, observed, visibility.unknown(observed, archived, ["date", "object_id"]), times)


def audit_artifact(spark, sf_dir):
    audit, _ = _audits(spark, sf_dir, _states(spark, sf_dir))
    missing = F.transform("missing_from_current_gp", lambda m: F.concat_ws("|", *[m[c] for c in ("norad_cat_id", "object_name", "last_gp_creation_date", "first_missing_in_current_gp_audit", "consecutive_missing_audits")]))
    back = F.transform("reappeared_in_current_gp", lambda m: F.concat_ws("|", m["norad_cat_id"], m["previously_missing_since"]))
    return audit.select("date", "observed_at_utc", "archive_object_count", "current_gp_object_count", "present_ids_sha256", "missing_from_current_gp_count", "present_in_current_gp_not_in_archive_count", "reappeared_in_current_gp_count", F.array_join(missing, ",").alias("missing"), F.array_join("present_in_current_gp_not_in_archive", ",").alias("unknown"), F.array_join(back, ",").alias("reappeared"))


def visibility_state(spark, sf_dir):
    _, states = _audits(spark, sf_dir, _states(spark, sf_dir))
    return states.select("date", F.explode("missing_objects").alias("object_id", "s")).select("date", "object_id", F.col("s.first_missing_in_current_gp_audit").alias("first_missing"), F.col("s.consecutive_missing_audits").alias("audits"), F.col("s.object_name").alias("object_name"))


# archives as files


def _archive(spark, sf_dir, root):
    """(run, artifacts): catalogs of a whole archive, staged below root as compressed files, and (date, name, text) of all else, whose manifests tell of those files."""
    states = stored(_states(spark, sf_dir), "states")
    pieces = stored(text_pieces(catalog_records(states), "object_id", "rec", ["snapshot_date"]), "pieces").withColumn("date", F.date_format("snapshot_date", "yyyy-MM-dd"))
    run = days.stage_days(pieces.select("date", F.lit(CATALOG).alias("name"), F.col("shard").alias("part"), "seq", "text"), root, lists=(CATALOG,))
    counts = pieces.groupBy("date").agg(F.sum("records").alias("objects"))
    hashed = days.staged(spark, root, run).select("date", F.col("bytes").alias("compressed_bytes"), "raw_bytes", "sha256").join(counts, "date")
    found = stored(archive.manifests_of(hashed, archived_at=ARCHIVED, strategy=STRATEGY, version=VERSION, genesis_at=GENESIS_AT), "manifests")
    changes = timeline.daily_changes(events(spark, sf_dir), EVENTS, F.lit(GENESIS_AT[:-1]).cast("timestamp_ntz"), base=_base(spark, sf_dir))
    audit, seen = _audits(spark, sf_dir, states)
    return run, artifacts.json_files(found, artifacts.deltas(changes, found, "user_id"), audit, seen)


CATALOG = archive.ARTIFACTS[0]


#: What is done to one artifact of a day, as (rule, artifact, pattern, replacement); without a pattern the artifact is left out. The day is that many after the first.
_RECORD = r"(\{[^}]*\})"
BREACHES = (
    ("R14", "catalog.json.gz", None, None), ("R14", "manifest.json", r'"object_count":\d+', '"object_count":0'),
    ("R01", "manifest.json", None, None), ("R02", "manifest.json", r"(?s)^(.{20}).*$", "$1"), ("R03", "manifest.json", r'"date":"[^"]*"', '"date":"2023-01-01"'),
    ("R04", "catalog.json.gz", r"(?s)^.*$", "no catalog"), ("R05", "manifest.json", r'"sha256":"[^"]*"', '"sha256":"00"'), ("R06", "catalog.json.gz", r"^\[", "[ "),
    ("R07", "manifest.json", r'"raw_bytes":\d+', '"raw_bytes":1'), ("R08", "manifest.json", r'"compressed_bytes":\d+', '"compressed_bytes":1'), ("R09", "manifest.json", r'"object_count":\d+', '"object_count":1'),
    ("R10", "catalog.json.gz", r'"EPOCH":"[^"]*",', ""), ("R11", "catalog.json.gz", r"^\[" + _RECORD, "[$1,$1"), ("R12", "catalog.json.gz", r"^\[" + _RECORD + "," + _RECORD, "[$2,$1"), ("R13", "catalog.json.gz", None, None),
    ("R15", "delta.json", None, None), ("R16", "delta.json", r"(?s)^(.{20}).*$", "$1"), ("R17", "delta.json", r'"date":"[^"]*"', '"date":"2023-01-01"'), ("R18", "delta.json", r'"window_start_utc":"[^"]*"', '"window_start_utc":"x"'), ("R19", "delta.json", r'"window_end_utc":"[^"]*"', '"window_end_utc":"x"'),
    ("R20", "delta.json", r'"new_object_count":\d+', '"new_object_count":999999'), ("R21", "delta.json", r'"updated_object_count":\d+', '"updated_object_count":999999'), ("R22", "delta.json", r'"unchanged_update_count":\d+', '"unchanged_update_count":999999'), ("R23", "delta.json", r'"ignored_older_update_count":\d+', '"ignored_older_update_count":999999'),
    ("R24", "delta.json", r'"deduped_update_count":\d+', '"deduped_update_count":999999'), ("R25", "manifest.json", r'"provenance":"[^"]*"', '"provenance":"genesis_from_gp"'), ("R26", "manifest.json", r'"provenance":"[^"]*"', '"provenance":"found"'),
    ("R27", "audit.json", None, None), ("R28", "visibility_state.json", None, None), ("R29", "audit.json", r"(?s)^(.{20}).*$", "$1"), ("R30", "audit.json", r'"date":"[^"]*"', '"date":"2023-01-01"'), ("R31", "audit.json", r'"archive_object_count":\d+', '"archive_object_count":999999'),
    ("R32", "audit.json", r'"missing_from_current_gp_count":\d+', '"missing_from_current_gp_count":999999'), ("R33", "audit.json", r'"present_in_current_gp_not_in_archive_count":\d+', '"present_in_current_gp_not_in_archive_count":999999'), ("R34", "audit.json", r'"reappeared_in_current_gp_count":\d+', '"reappeared_in_current_gp_count":999999'),
    ("R35", "visibility_state.json", r"(?s)^(.{20}).*$", "$1"), ("R36", "visibility_state.json", r'"date":"[^"]*"', '"date":"2023-01-01"'), ("R37", "visibility_state.json", r'"observed_at_utc":"[^"]*"', '"observed_at_utc":"x"'), ("R38", "visibility_state.json", '"missing_objects"', '"objects"'), ("R39", "visibility_state.json", r'(?s)"missing_objects":.*$', '"missing_objects":{}}'),
)
#: Rules that a breach breaks besides its own.
ALSO = {"R06": ("R05", "R07", "R08"), "R09": ("R31",), "R10": ("R05", "R07", "R08"), "R11": ("R05", "R07", "R08", "R09"), "R12": ("R05", "R08"), "R14": ("R31",), "R20": ("R24",), "R21": ("R24",), "R22": ("R24",), "R23": ("R24",), "R32": ("R39",)}


def breach_day(rule: str) -> str:
    """Each rule's day; R14 has the first."""
    from datetime import date, timedelta

    return str(date.fromisoformat(FIRST) + timedelta(days=0 if rule == "R14" else int(rule[1:])))


def _broken_days(spark, sf_dir):
    root = new_path(spark, "archive")
    run, others = _archive(spark, sf_dir, root)
    sound = days.staged(spark, root, run)
    paths = [f"{root}/{r['path']}" for r in sound.select("path").collect()]
    cuts = catalogs.cuts(spark, paths).select(F.regexp_extract("path", r"/([0-9-]{10})/[^/]+$", 1).alias("date"), F.lit(CATALOG).alias("name"), F.col("at").alias("seq"), "text")
    here = lambda rule, name: (F.col("date") == breach_day(rule)) & (F.col("name") == name)
    gone = reduce(lambda a, b: a | b, [here(rule, name) for rule, name, pattern, _ in BREACHES if pattern is None])
    changes = [F.when(here(rule, name), F.regexp_replace("text", pattern, new)) for rule, name, pattern, new in BREACHES if pattern is not None]
    # catalogs are changed record by record, as each is a cut of its own: two records of R12 change places, all of R04 is one text
    swapped = here("R12", CATALOG) & (F.col("seq") < 2)
    cuts = cuts.where(~here("R04", CATALOG) | (F.col("seq") == 0)).select("date", "name", F.when(swapped, 1 - F.col("seq")).otherwise(F.col("seq")).alias("seq"), F.when(swapped, F.concat(F.when(F.col("seq") == 0, ",").otherwise("["), F.expr("substr(text, 2)"))).otherwise(F.col("text")).alias("text"))
    files = cuts.unionByName(others.withColumn("seq", F.lit(0)))
    days.write_days(files.where(~gone).withColumn("text", F.coalesce(*changes, "text")), root)
    return archive.written_days(spark, root, date_spine(spark, FIRST, LAST).select(day("date")))


def archive_audit(spark, sf_dir):
    return rules.day_violations(_broken_days(spark, sf_dir), least=1, require_audit=True, latest_catalogs=40).select("date", "rule")


def restore_checked(spark, sf_dir):
    days = _broken_days(spark, sf_dir)
    dates = days.select("date")
    plan = maintenance.restore(dates, dates.where("day(date) % 4 = 0"), start="2024-01-03", end="2024-02-10")
    return maintenance.restore_checked(plan, days)


def _sound_archive(spark, sf_dir):
    root = new_path(spark, "archive")
    run, others = _archive(spark, sf_dir, root)
    days.write_days(others, root, staged=(run,))
    # a run for the last day again, without its audit, leaves no audit of the earlier run
    again = days.stage_days(days.staged(spark, root, run).where(F.col("date") == LAST).select("date", "name", F.lit("[]").alias("text")), root)
    days.write_days(others.where((F.col("date") == LAST) & (F.col("name") == "manifest.json")), root, staged=(again,))
    return root


def file_inventory(spark, sf_dir):
    """Every catalog and audit that is visible; of catalogs what the compressed file holds, read as a stream, and whether its bytes are those that were written."""
    root = _sound_archive(spark, sf_dir)
    shown = stored(days.visible(spark, root).where(F.col("name").isin(CATALOG, "audit.json")), "visible")
    key = lambda c: F.regexp_extract(c, r"/(_files/.+)$", 1).alias("key")
    hashed = files.file_hashes(shown.select("path", "bytes")).select(key("path"), F.col("sha256").alias("file_sha256"))
    facts = catalogs.catalog_facts(spark, [r["path"] for r in shown.where(F.col("name") == CATALOG).select("path").collect()])
    facts = facts.select(key("path"), "compressed_bytes", "catalog.raw_bytes", F.col("catalog.sha256").alias("held"))
    same = F.when(F.col("name") == CATALOG, F.col("compressed_bytes") == F.col("bytes")).otherwise(F.col("file_sha256") == F.col("sha256"))
    found = shown.select("date", "name", "bytes", "sha256", key("path")).join(hashed, "key").join(facts, "key", "left")
    return found.select("date", "name", F.col("raw_bytes").alias("bytes"), F.col("held").alias("sha256"), same.alias("intact"))


def catalog_rows(spark, sf_dir):
    """Every record of every day, out of the compressed files."""
    root = _sound_archive(spark, sf_dir)
    paths = [r["path"] for r in days.visible(spark, root).where(F.col("name") == CATALOG).select("path").collect()]
    found = catalogs.catalog_rows(spark, paths)
    rec = lambda c: F.col("rec")[c]
    return found.select(F.regexp_extract("path", r"/([0-9-]{10})/[^/]+$", 1).alias("date"), "pos", "object_id", rec("GP_ID").alias("gp_id"), rec("OBJECT_NAME").alias("object_name"), rec("CREATION_DATE").alias("created"), F.size("rec").cast("long").alias("fields"))


def ledger_rules(spark, sf_dir):
    """Ledgers of the same archive, each broken in its own way, as texts."""
    days = stored(_manifests(spark, sf_dir), "manifests")
    entry = F.to_json(F.struct("date", "sha256", "object_count", "compressed_bytes", "provenance", "query_strategy", "archived_at", "state_as_of_utc", "base_snapshot_date", "base_snapshot_sha256", "delta_window_start_utc", "delta_window_end_utc"))
    whole = days.agg(F.array_sort(F.collect_list(F.struct("date", entry.alias("e")))).alias("l")).select(F.transform("l", lambda x: x["e"]).alias("e"))
    listed = lambda e: F.concat(F.lit("["), F.array_join(e, ","), F.lit("]"))
    e = F.col("e")
    cases = {
        "cut": F.substring(listed(e), 1, 50), "no_list": F.lit('{"date":"2024-01-02"}'), "fine": listed(e), "repeated": listed(F.concat(e, F.slice(e, -1, 1))), "swapped": listed(F.concat(F.slice(e, 2, 1), F.slice(e, 1, 1), F.slice(e, F.lit(3), F.size(e)))),
        "short": listed(F.slice(e, F.lit(1), F.size(e) - 1)), "no_object": listed(F.concat(e, F.array(F.lit("5")))), "altered": listed(F.transform(e, lambda x: F.when(x.contains('"date":"2024-01-05"'), F.regexp_replace(x, '"object_count":[0-9]+', '"object_count":1')).otherwise(x))),
    }
    texts = stored(whole.select(F.explode(F.array(*[F.struct(F.lit(case).alias("case"), text.alias("text")) for case, text in cases.items()])).alias("c")).select("c.*"), "ledgers")
    of_all = days.withColumn("case", F.explode(F.array(*[F.lit(case) for case in ("absent", *cases)])))
    return rules.ledger_text_violations(texts, of_all, ("case",)).select("case", "rule", "detail")


# timelines over archives


def resume_archive(spark, sf_dir):
    """Two days are archived already, each with the state of two days before."""
    rows = events(spark, sf_dir)
    days = [timeline.as_of(rows, EVENTS, F.lit(held).cast("timestamp_ntz")).withColumn("snapshot_date", F.lit(d).cast("date")).withColumn("state_as_of", F.lit(d).cast("timestamp_ntz")) for held, d in (("2024-01-08", "2024-01-10"), ("2024-01-18", "2024-01-20"))]
    found = timeline.resume(rows, EVENTS, days[0].unionByName(days[1]))
    return timeline.daily_agreement(timeline.daily_states(found, "2024-01-10", "2024-01-31"), EVENTS).select(day("snapshot_date"), "objects", "checksum")


def id_gap_changes(spark, sf_dir):
    return profile.id_gap_changes(_states(spark, sf_dir), "user_id").select(day("snapshot_date"), "present", "missing", "largest_gap", "present_change", "missing_change", "gap_change")


def heaviest_branch(spark, sf_dir):
    """Orders as blocks: one in three forks off its grandparent. Attesters are customers, whose scores change with their orders."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    line = orders.select((F.col("o_orderkey") % 40).alias("chain"), F.col("o_orderkey").alias("block"), F.col("o_custkey").alias("attester"), F.col("o_orderdate").alias("block_time"))
    blocks = line.withColumn("parent", F.expr("if(block % 3 = 0, lag(block, 2) over (partition by chain order by block), lag(block) over (partition by chain order by block))"))
    scores = orders.groupBy(F.col("o_custkey").alias("attester"), F.expr("o_orderdate - interval 30 days").alias("score_time")).agg(F.max(F.col("o_orderkey") % 100).alias("score"))
    attested = profile.scored_attestations(line.select("chain", "block", "attester", "block_time"), scores)
    found = profile.heaviest_branch(blocks.select("chain", "block", "parent"), attested.select("chain", "block", "score"))
    return found.select("chain", "tip", F.col("weight").cast("long"), F.col("length").cast("long"))


def publication(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderkey").alias("k"))
    days = orders.groupBy("date").agg(F.max("k").alias("k"))
    bundles = days.select("date", F.col("k").cast("string").alias("bundle_sha256"))
    receipts = days.where("k % 2 = 0").select("date", F.lit(maintenance.STORE).alias("destination"), F.expr("if(k % 4 = 0, cast(k as string), 'old')").alias("bundle_sha256"))
    releases = days.where("k % 3 <> 0").select("date", F.expr("k % 5 <> 0").alias("has_asset"))
    plans = {"none": ("none", "if_missing", False, False), "never": ("arweave", "never", False, False), "store": ("arweave", "if_missing", False, False), "mirror": ("arweave", "always_mirror", False, False), "release": ("github_release", "if_missing", False, False), "forced": ("github_release", "if_missing", True, False), "early": ("github_release", "if_missing", False, True)}
    return reduce(DataFrame.union, [maintenance.publication(bundles, receipts, releases, *p).groupBy("destination", "status", "reason").agg(F.count("*").alias("n")).select(F.lit(name).alias("plan"), "destination", "status", "reason", "n") for name, p in plans.items()])


def _chunks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "utf-8").alias("content"))
    return merkle.chunks(docs, size=4096, least=512)


def merkle_proofs(spark, sf_dir):
    """Every chunk's proof against its document's root, and how long it is."""
    found = _chunks(spark, sf_dir)
    proofs = merkle.proofs(found)
    checked = merkle.check_proofs(proofs, merkle.roots(found))
    return checked.join(proofs.select("path", "pos", F.size("proof").alias("levels"), "start", "end"), ["path", "pos"]).select("path", "pos", "start", "end", "levels", "ok")


_KEYS = ("ARG_OF_PERICENTER", "CREATION_DATE", "ECCENTRICITY", "EPOCH", "GP_ID", "INCLINATION", "MEAN_ANOMALY", "MEAN_MOTION", "NORAD_CAT_ID", "OBJECT_NAME", "RA_OF_ASC_NODE")
_VALUES = {"CREATION_DATE": "strftime(ts, '%Y-%m-%dT%H:%M:%S')", "EPOCH": "strftime(ts, '%Y-%m-%dT%H:%M:%S')", "NORAD_CAT_ID": "user_id", "OBJECT_NAME": "event_type"}
_JSON = " || ',' || ".join(f"""'"{k}":"' || {_VALUES.get(k, 'event_id')} || '"'""" for k in _KEYS)
#: (d, user_id, event_id, event_type, ts) of every day's state; the first day's stands for six o'clock.
_STATES_SQL = f"""spine as (select cast(unnest(generate_series(date '{FIRST}', date '{LAST}', interval 1 day)) as date) as d),
  cuts as (select d, case when d = date '{FIRST}' then timestamp '2024-01-02 06:00:00' else cast(d as timestamp) end as cut from spine),
  kept as (select user_id, event_id, event_type, ts, case when ts < timestamp '2024-01-02 06:00:00' then date '{FIRST}' else cast(ts as date) + 1 end as d from events
           qualify row_number() over (partition by user_id, case when ts < timestamp '2024-01-02 06:00:00' then date '{FIRST}' else cast(ts as date) + 1 end order by ts desc, event_id desc) = 1),
  spans as (select *, coalesce(lead(d) over (partition by user_id order by d) - 1, date '{LAST}') as z from kept),
  states as (select spine.d, user_id, event_id, event_type, ts from spine join spans on spine.d between spans.d and spans.z)"""
_CATALOGS_SQL = f"""{_STATES_SQL}, catalogs as (select strftime(d, '%Y-%m-%d') as date, '[' || string_agg('{{' || {_JSON} || '}}', ',' order by user_id) || ']' as t, count(*) as n from states group by d)"""
_SIGHT_SQL = f"""{_STATES_SQL}, seen as (select *, (user_id + dayofyear(d) // 3) % 5 <> 0 as present from states),
  marked as (select *, lag(d) over (partition by user_id order by d) as before, lag(present) over (partition by user_id order by d) as was from seen),
  runs as (select *, sum(case when present or was is null or was then 1 else 0 end) over (partition by user_id order by d) as run from marked),
  found as (select *, strftime(d, '%Y-%m-%d') as date, count(*) filter (not present) over (partition by user_id, run order by d) as n, min(case when not present then strftime(d, '%Y-%m-%d') || 'T06:00:00Z' end) over (partition by user_id, run order by d) as since from runs),
  back as (select *, lag(since) over (partition by user_id order by d) as missed from found)"""

ORACLES = {
    "manifest_full": f"""with {_CATALOGS_SQL}, m as (select *, case when date = '{FIRST}' then '{GENESIS_AT}' else date || 'T00:00:00Z' end as as_of, sha256(t) as sha from catalogs)
      select date, as_of as cutoff_utc, as_of as state_as_of_utc, sha as sha256, n as object_count, cast(strlen(t) as bigint) as raw_bytes, cast(strlen(t) as bigint) as compressed_bytes, case when date = '{FIRST}' then 'genesis_from_gp' else 'rolling_gp_history_delta' end as provenance,
        'OMM/JSON' as format, 'space-track.org' as source, '{VERSION}' as pipeline_version, '{STRATEGY}' as query_strategy, '{ARCHIVED}' as archived_at, lag(date) over (order by date) as base_snapshot_date, lag(sha) over (order by date) as base_snapshot_sha256,
        lag(as_of) over (order by date) as delta_window_start_utc, case when date <> '{FIRST}' then as_of end as delta_window_end_utc, case when date = '{FIRST}' then as_of end as observed_at_utc from m""",
    "replay_late": f"""with {_LATE_SQL}, w as (select d, sum(raw_rows) as raw_rows, count(*) as deduped, count(*) filter (change in ('new', 'updated')) as applied, count(*) filter (change = 'ignored_older') as ignored, count(*) filter (change = 'new') as f from changes group by d)
      select strftime(d, '%Y-%m-%d') as window_date, cast(raw_rows as bigint) as raw_rows, deduped, applied, ignored, cast(sum(f) over (order by d) - f as bigint) as objects_before, cast(sum(f) over (order by d) as bigint) as objects_after from w""",
    "delta_artifact": f"""with {_LATE_SQL}, spine as (select cast(unnest(generate_series(date '2024-01-03', date '2024-02-05', interval 1 day)) as date) as d),
      w as (select d + 1 as d, cast(sum(raw_rows) as bigint) as raw_row_count, count(*) as deduped_update_count, {', '.join(f"count(*) filter (change = '{k}') as {n}" for k, n in (("new", "new_object_count"), ("updated", "updated_object_count"), ("unchanged", "unchanged_update_count"), ("ignored_older", "ignored_older_update_count")))},
        {', '.join(f"coalesce(string_agg(cast(user_id as varchar), ',' order by user_id) filter (change = '{k}'), '') as {n}" for k, n in (("new", "new_norad_cat_ids"), ("updated", "updated_norad_cat_ids"), ("unchanged", "unchanged_update_norad_cat_ids"), ("ignored_older", "ignored_older_update_norad_cat_ids")))} from changes group by d),
      total as (select s.d, (select count(distinct user_id) from changes c where c.d + 1 < s.d) as held from spine s)
      select strftime(s.d, '%Y-%m-%d') as date, strftime(s.d - 1, '%Y-%m-%d') || 'T00:00:00Z' as window_start_utc, strftime(s.d, '%Y-%m-%d') || 'T00:00:00Z' as window_end_utc, {', '.join(f"coalesce({n}, 0) as {n}" for n in ("raw_row_count", "deduped_update_count", "new_object_count", "updated_object_count", "unchanged_update_count", "ignored_older_update_count"))},
        held - coalesce(updated_object_count + unchanged_update_count + ignored_older_update_count, 0) as carried_forward_count, {', '.join(f"coalesce({n}, '') as {n}" for n in ("new_norad_cat_ids", "updated_norad_cat_ids", "unchanged_update_norad_cat_ids", "ignored_older_update_norad_cat_ids"))} from spine s join total using (d) left join w using (d)""",
    "audit_artifact": f"""with {_SIGHT_SQL}, o as (select date, user_id as i from found where present union all select date, user_id + 1000000000 from found where user_id % 9 = 0),
      seen_ids as (select date, count(*) as c, sha256(string_agg(cast(i as varchar), chr(10) order by i)) as h from o group by date),
      x as (select date, count(*) as c, string_agg(cast(user_id + 1000000000 as varchar), ',' order by user_id) as l from found where user_id % 9 = 0 group by date)
      select date, date || 'T06:00:00Z' as observed_at_utc, count(*) as archive_object_count, any_value(seen_ids.c) as current_gp_object_count, any_value(h) as present_ids_sha256, count(*) filter (not present) as missing_from_current_gp_count, coalesce(any_value(x.c), 0) as present_in_current_gp_not_in_archive_count,
        count(*) filter (present and was = false) as reappeared_in_current_gp_count, coalesce(string_agg(user_id || '|' || event_type || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '|' || since || '|' || n, ',' order by user_id) filter (not present), '') as missing,
        coalesce(any_value(l), '') as unknown, coalesce(string_agg(user_id || '|' || missed, ',' order by user_id) filter (present and was = false), '') as reappeared from back join seen_ids using (date) left join x using (date) group by date""",
    "visibility_state": f"with {_SIGHT_SQL} select date, cast(user_id as varchar) as object_id, since as first_missing, n as audits, event_type as object_name from found where not present",
    "archive_audit": "select * from (values " + ", ".join(f"('{breach_day(r)}', '{x}')" for r in sorted({b[0] for b in BREACHES}) for x in (r, *ALSO.get(r, ()))) + ") as t(date, rule)",
    "restore_checked": f"""with spine as (select cast(unnest(generate_series(date '2024-01-03', date '2024-02-10', interval 1 day)) as date) as d)
      select strftime(d, '%Y-%m-%d') as date, case when day(d) % 4 = 0 then 'skipped' else coalesce(w, 'hydrated') end as status from spine left join (values {', '.join(f"(date '{breach_day(r)}', '{w}')" for r, w in (("R01", "unreadable"), ("R02", "unreadable"), ("R04", "unreadable"), ("R05", "sha256"), ("R06", "sha256"), ("R07", "raw_bytes"), ("R08", "compressed_bytes"), ("R09", "object_count"), ("R10", "sha256"), ("R11", "sha256"), ("R12", "sha256"), ("R13", "unreadable")))}) as t(d, w) using (d)""",
    "file_inventory": f"""with {_CATALOGS_SQL} select date, 'catalog.json.gz' as name, cast(case when date = '{LAST}' then 2 else strlen(t) end as bigint) as bytes, sha256(case when date = '{LAST}' then '[]' else t end) as sha256, true as intact from catalogs
      union all select date, 'audit.json', null, null, true from catalogs where date <> '{LAST}'""",
    "catalog_rows": f"""with {_STATES_SQL} select strftime(d, '%Y-%m-%d') as date, row_number() over (partition by d order by user_id) - 1 as pos, cast(user_id as varchar) as object_id, cast(event_id as varchar) as gp_id, event_type as object_name, strftime(ts, '%Y-%m-%dT%H:%M:%S') as created, cast(11 as bigint) as fields
      from states where d <> date '{LAST}'""",
    "ledger_rules": f"""with {_STATES_SQL}, days as (select d, count(*) as n from states group by d)
      select * from (values ('absent', 'L01', 'ledger'), ('cut', 'L02', 'ledger'), ('no_list', 'L03', 'ledger')) as t("case", rule, detail)
      union all select 'repeated', 'L04', 'repeated date' from days where d = (select max(d) from days) union all select 'swapped', 'L05', 'not in date order' from days where d = (select min(d) from days) having count(*) > 0
      union all select 'short', 'L06', 'only in manifests' from days where d = (select max(d) from days) union all select 'no_object', 'L07', 'entry ' || count(*) from days union all select 'altered', 'L08', 'object_count' from days where d = date '2024-01-05' and n <> 1""",
    "resume_archive": """with spine as (select cast(unnest(generate_series(date '2024-01-10', date '2024-01-31', interval 1 day)) as date) as d, case when d < date '2024-01-20' then date '2024-01-10' else date '2024-01-20' end as s),
      r as (select d, user_id, event_id, row_number() over (partition by d, user_id order by ts desc, event_id desc) as r from spine join events on ts < d and (ts >= s or ts < s - interval 2 days))
      select strftime(d, '%Y-%m-%d') as snapshot_date, count(*) as objects, cast(sum(event_id) as bigint) as checksum from r where r = 1 group by d""",
    "id_gap_changes": f"""with {_STATES_SQL}, i as (select d, user_id as i, lead(user_id) over (partition by d order by user_id) as n from states),
      g as (select d, count(*) as present, max(i) - min(i) + 1 - count(*) as missing, coalesce(max(n - i - 1), 0) as largest_gap from i group by d)
      select strftime(d, '%Y-%m-%d') as snapshot_date, present, missing, largest_gap, present - lag(present) over (order by d) as present_change, missing - lag(missing) over (order by d) as missing_change, largest_gap - lag(largest_gap) over (order by d) as gap_change from g""",
    "heaviest_branch": """with recursive line as (select o_orderkey % 40 as chain, o_orderkey as block, o_custkey as c, o_orderdate as t, lag(o_orderkey) over w as p1, lag(o_orderkey, 2) over w as p2 from orders window w as (partition by o_orderkey % 40 order by o_orderkey)),
      scores as (select o_custkey as c, o_orderdate - interval 30 days as t, max(o_orderkey % 100) as s from orders group by all),
      w as (select line.chain, block, case when block % 3 = 0 then p2 else p1 end as parent, coalesce((select arg_max(s, scores.t) from scores where scores.c = line.c and scores.t <= line.t), 0) as w from line),
      walk as (select chain, block, w as weight, 1 as n from w where parent is null union all select w.chain, w.block, walk.weight + w.w, n + 1 from walk join w on w.chain = walk.chain and w.parent = walk.block),
      tips as (select * from walk where not exists (select 1 from w where w.chain = walk.chain and w.parent = walk.block))
      select chain, block as tip, cast(weight as bigint) as weight, cast(n as bigint) as length from tips qualify row_number() over (partition by chain order by weight desc, block) = 1""",
    "publication": """with d as (select strftime(o_orderdate, '%Y-%m-%d') as date, max(o_orderkey) as k from orders group by 1),
      s as (select case when k % 4 = 0 then 'skipped' else 'uploaded' end as store, case when k % 3 = 0 then 'created' when k % 5 = 0 then 'uploaded' else 'exists' end as r from d),
      p as (select 'none' as plan, null as destination, 'skipped' as status, 'upload_disabled' as reason from s union all select 'never', null, 'skipped', 'upload_disabled' from s union all select 'store', 'arweave', store, null from s union all select 'mirror', 'arweave', 'uploaded', null from s
        union all select 'release', 'github_release', case r when 'exists' then 'skipped' else r end, null from s union all select 'release', 'arweave', store, null from s union all select 'forced', 'github_release', case r when 'exists' then 'uploaded' else r end, null from s
        union all select 'forced', 'arweave', 'uploaded', null from s union all select 'early', 'github_release', case r when 'exists' then 'metadata_updated' else r end, null from s union all select 'early', 'arweave', store, null from s)
      select plan, destination, status, reason, count(*) as n from p group by all""",
}

#: Chunks of documents, and as many layers of hashes as 4,096 chunks need; texts beyond that would need more.
_CHUNKS_SQL = """c as (select cast(doc_id as varchar) as path, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, ''))) as n from documents),
  s as (select *, n // 4096 as whole, n % 4096 as rest from c), k as (select *, case when whole >= 1 and rest > 0 and rest < 512 then (4096 + rest + 1) // 2 end as cut, unnest(range(0, whole + 1)) as pos from s),
  chunks as (select path, n, pos, case when cut is not null and pos = whole then (whole - 1) * 4096 + cut else pos * 4096 end as a, case when cut is not null and pos = whole - 1 then pos * 4096 + cut else least((pos + 1) * 4096, n) end as z, b from k),
  l0 as (select path, pos, unhex(sha256(unhex(sha256(unhex(sha256(b[a + 1:z])))) || unhex(sha256(unhex(lpad(hex(z), 64, '0')))))) as id, z from chunks)"""
_LAYERS_SQL = _CHUNKS_SQL + "".join(
    f""", l{i + 1} as (select path, pos // 2 as pos, case when count(*) = 1 then arg_min(id, pos) else unhex(sha256(unhex(sha256(arg_min(id, pos))) || unhex(sha256(arg_max(id, pos))) || unhex(sha256(unhex(lpad(hex(min(z)), 64, '0')))))) end as id, max(z) as z from l{i} group by path, pos // 2)"""
    for i in range(12)
)
ORACLES["merkle_roots"] = f"with {_LAYERS_SQL} select path, cast(z as bigint) as bytes, lower(hex(id)) as root from l12"
#: A chunk has a sibling on every level but where it is last and alone.
ORACLES["merkle_proofs"] = f"""with {_CHUNKS_SQL}, t as (select *, max(pos) over (partition by path) as last from chunks),
  v as (select path, pos, a, z, unnest(range(0, 20)) as i, last from t where z > a)
  select path, cast(pos as bigint) as pos, cast(a as bigint) as start, cast(z as bigint) as "end", cast(count(*) filter (xor(pos >> i, 1) <= last >> i and last >> i > 0) as int) as levels, true as ok from v group by all"""

QUERIES = {f.__name__: f for f in (manifest_full, replay_late, delta_artifact, audit_artifact, visibility_state, archive_audit, restore_checked, file_inventory, catalog_rows, ledger_rules, resume_archive, id_gap_changes, heaviest_branch, publication, merkle_proofs)}
