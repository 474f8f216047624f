"""Daily archives as queries build them, against their SQL, and the small pieces they are made of."""

import datetime as dt
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.feed import Feed
from tidemark.functions import scalars
from tidemark.operators import maintenance, merge, profile, rules, timeline, windows
from tidemark.plans import archives
from tidemark.plans import queries as plans
from tidemark.sources import archive

FEED = Feed("id", "created", ("tie",))
KIND = "id string, created timestamp_ntz, tie long, v string"


def at(text):
    return dt.datetime.fromisoformat(text)


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


def same(spark, sf, query, sql):
    found = query(spark, sf)
    columns = sorted(found.columns)
    con = duckdb.connect()
    for name in ("events", "orders", "documents"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    key = lambda row: [str(plain(x)) for x in row]
    assert sorted(key(r[c] for c in columns) for r in found.collect()) == sorted(key(r[names.index(c)] for c in columns) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(archives.QUERIES))
def test_queries_against_sql(spark, sf, name):
    same(spark, sf, archives.QUERIES[name], archives.ORACLES[name])


@pytest.mark.parametrize("name", ["merkle_roots", "hourly_budget", "replay_windows", "archive_rules"])
def test_other_queries_against_sql(spark, sf, name):
    same(spark, sf, plans.QUERIES[name], archives.ORACLES.get(name) or plans.ORACLES[name])


def test_dates_and_summaries(spark):
    row = spark.range(1).select(scalars.parse_date(F.lit("2024-03-01")).alias("d")).select("d", scalars.date_text("d").alias("t"), scalars.previous_date("d").alias("p")).first()
    assert (row.d, row.t, row.p) == (dt.date(2024, 3, 1), "2024-03-01", dt.date(2024, 2, 29))
    with pytest.raises(Exception, match="2024-13-01"):
        spark.createDataFrame([("2024-13-01",)], "d string").select(scalars.parse_date("d")).collect()
    rec = {"NORAD_CAT_ID": "5", "OBJECT_NAME": "X", "EPOCH": "e", "CREATION_DATE": "c", "GP_ID": "9", "OTHER": "z"}
    found = spark.createDataFrame([(rec,), ({"GP_ID": None},)], "rec map<string,string>").select(scalars.compact("rec").alias("s")).collect()
    assert [tuple(r.s) for r in found] == [("5", "X", "e", "c", "9"), (None,) * 5]


def test_pull_counts_raw_rows(spark):
    rows = [("1", at("2024-01-01T10:00"), 1, "a"), ("1", at("2024-01-01T12:00"), 1, "b"), ("2", at("2024-01-01T00:00"), 1, "c"), (None, at("2024-01-01T05:00"), 1, "d"), ("1", at("2024-01-02T00:00"), 1, "late")]
    latest, counts = windows.pull(spark.createDataFrame(rows, KIND), FEED, at("2024-01-01"), at("2024-01-02"))
    assert sorted((r.id, r.v) for r in latest.collect()) == [("1", "b"), ("2", "c")]
    assert tuple(counts.first()) == (4, 2)


def test_observation_is_sorted_and_checked(spark):
    rec = dict.fromkeys(rules.REQUIRED_FIELDS, "1")
    rows = [("t1", "10", rec), ("t1", "9", rec), ("t2", "1", {})]
    df = spark.createDataFrame(rows, "observed_at string, object_id string, rec map<string,string>")
    assert [r.object_id for r in archive.observation(df, "t1").collect()] == ["9", "10"]
    assert archive.checked_observation(df, "t1", 2).count() == 2
    with pytest.raises(ValueError, match="below the minimum"):
        archive.checked_observation(df, "t1", 3)
    with pytest.raises(ValueError, match="misses fields"):
        archive.checked_observation(df, "t2", 1)


def test_integer_ids_reach_the_scan(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/events.parquet")
    feed = Feed("user_id", "ts", ("event_id",))
    found = archive.history(df, feed, at("2024-01-05"), at("2024-01-06"), 9, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "user_id" in pushed and "ts" in pushed
    assert {r.range_low for r in found.collect()} <= {0, 5}


def test_changes_of_late_rows(spark):
    rows = [("1", at("2024-01-01T10:00"), 1, "a", at("2024-01-01T10:00")), ("1", at("2023-12-01T10:00"), 1, "old", at("2024-01-02T10:00")), ("1", at("2024-01-01T10:00"), 1, "a", at("2024-01-03T10:00")), ("1", at("2024-01-04T10:00"), 1, "b", at("2024-01-04T10:00")), (None, at("2024-01-04T10:00"), 1, "b", at("2024-01-04T10:00"))]
    df = spark.createDataFrame(rows, KIND + ", arrived timestamp_ntz")
    found = timeline.daily_changes(df, FEED, arrived="arrived").where("id is not null").orderBy("window_date").collect()
    assert [r.change for r in found] == [merge.NEW, merge.IGNORED, merge.UNCHANGED, merge.UPDATED]
    days = timeline.replay_windows(df, FEED, None, None, "arrived").orderBy("window_date").collect()
    assert [tuple(r)[1:] for r in days] == [(1, 1, 1, 0, 0, 1), (1, 1, 0, 1, 1, 1), (1, 1, 0, 0, 1, 1), (2, 1, 1, 0, 1, 1)]
    base = df.where("v = 'b' and id is not null").drop("arrived")
    again = timeline.daily_changes(df.drop("arrived"), FEED, base=base).where("id is not null").orderBy("window_date").collect()
    assert [r.change for r in again] == [merge.IGNORED, merge.IGNORED, merge.UNCHANGED]


def test_resume_has_no_range_join(spark):
    rows = [("1", at("2024-01-01T10:00"), 1, "a"), ("1", at("2024-01-12T10:00"), 1, "b"), ("2", at("2024-01-15T10:00"), 1, "c")]
    df = spark.createDataFrame(rows, KIND)
    snapshots = spark.createDataFrame([(*rows[0], dt.date(2024, 1, 10), at("2024-01-10"))], KIND + ", snapshot_date date, state_as_of timestamp_ntz")
    found = timeline.resume(df, FEED, snapshots)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()
    states = timeline.daily_states(found, "2024-01-10", "2024-01-17").groupBy("snapshot_date").agg(F.array_join(F.array_sort(F.collect_list("v")), "").alias("v")).orderBy("snapshot_date")
    assert [r.v for r in states.collect()] == ["a", "a", "a", "b", "b", "b", "bc", "bc"]


def test_files_of_a_day_are_replaced_whole(spark, tmp_path):
    kind, root = "date string, name string, text string", str(tmp_path / "archive")
    archive.write_files(spark.createDataFrame([("2024-01-01", "manifest.json", "{}"), ("2024-01-01", "audit.json", "a\nb"), ("2024-01-02", "manifest.json", "é")], kind), root)
    archive.write_files(spark.createDataFrame([("2024-01-01", "manifest.json", "{1}")], kind), root)
    found = archive.stored_files(spark, root).orderBy("date", "name").collect()
    assert [(r.date, r.name, r.text, r.file_bytes) for r in found] == [("2024-01-01", "manifest.json", "{1}", 3), ("2024-01-02", "manifest.json", "é", 2)]


def test_publication_rejects_what_it_does_not_know(spark):
    none = spark.createDataFrame([], "date string, bundle_sha256 string")
    with pytest.raises(ValueError, match="policy"):
        maintenance.publication(none, none, none, "arweave", "if_changed")
    with pytest.raises(ValueError, match="backend"):
        maintenance.publication(none, none, none, "elsewhere")


def test_hourly_budget_across_hours(spark):
    uses = [("s", at(f"2024-01-01T{h:02}:{m:02}"), 1) for h in range(3) for m in (0, 20, 59)] + [("t", at("2024-01-01T01:00"), 5)]
    found = profile.hourly_budget(spark.createDataFrame(uses, "signer string, at timestamp_ntz, cost long"), 4).collect()
    for r in found:
        want = sum(c for s, t, c in uses if s == r.signer and r.at - dt.timedelta(hours=1) <= t <= r.at)
        assert r.spent == want and r.within == (want <= 4)
    assert len(found) == len(uses)


def test_hourly_budget_of_many_uses_in_an_hour(spark):
    """A signer's busy hours, ties at both ends of the hour before, costs without a value; uses without a time count once."""
    rng = random.Random(6)
    when = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    uses = [(rng.choice("ab"), when(rng.randrange(400)), rng.choice([None, 1, 2, 5])) for _ in range(600)] + [("c", None, 3), ("c", None, 4), ("c", when(5), 1)]
    df = spark.createDataFrame(uses, "signer string, at timestamp_ntz, cost long")
    found = profile.hourly_budget(df, 50)

    def spent(s, t):
        costs = [c for s2, t2, c in uses if s2 == s and c is not None and ((t is None and t2 is None) or (t is not None and t2 is not None and dt.timedelta(0) <= t - t2 <= dt.timedelta(hours=1)))]
        return sum(costs) if costs else None

    assert Counter(map(tuple, found.select("signer", "at", "cost", "spent", "within").collect())) == Counter((s, t, c, spent(s, t), None if spent(s, t) is None else spent(s, t) <= 50) for s, t, c in uses)
    # no frame that begins anew for each row
    frames = re.findall(r"specifiedwindowframe\(([^()]*(?:\(\)[^()]*)*)\)", found._jdf.queryExecution().optimizedPlan().toString().lower())
    assert frames and all("unboundedpreceding" in f for f in frames)
