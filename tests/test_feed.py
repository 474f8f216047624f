"""Windows, merges, timelines and visibility on inline rows, and properties against plain simulations."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.feed import Feed
from tidemark.functions.scalars import date_spine, id_ranges, lenient_int, selection_key, time_text
from tidemark.operators import maintenance, merge, timeline, visibility, windows

FEED = Feed("object_id", "created", ("tie",))
SCHEMA = "object_id string, created string, tie int, name string"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_window_is_half_open(spark):
    times = ["2026-04-11T23:59:59", "2026-04-12T00:00:00", "2026-04-12T12:00:00", "2026-04-13T00:00:00", "", None]
    df = spark.createDataFrame([(str(i), t, 0, "") for i, t in enumerate(times)], SCHEMA)
    assert rows(windows.in_window(df, FEED, "2026-04-12T00:00:00", "2026-04-13T00:00:00"), "object_id") == [("1",), ("2",)]
    assert windows.in_window(df, FEED).count() == 6


def test_latest_prefers_time_then_tie_and_drops_null_ids(spark):
    df = spark.createDataFrame([("1", "a", 9, "x"), ("1", "a", 10, "y"), ("1", "0", 99, "z"), (None, "b", 1, "n"), ("01", "a", 1, "w")], SCHEMA)
    assert rows(windows.latest(df, FEED), "object_id", "name") == [("01", "w"), ("1", "y")]
    again = df.union(df)
    assert rows(windows.latest(again, FEED), "object_id", "name") == [("01", "w"), ("1", "y")]


def test_equal_keys_are_decided_alike_in_any_order(spark):
    df = spark.createDataFrame([("1", "a", 1, n) for n in "pqrst"], SCHEMA)
    assert rows(windows.latest(df, FEED), "name") == rows(windows.latest(df.orderBy(F.desc("name")).repartition(3), FEED), "name")


def test_scalars(spark):
    df = spark.createDataFrame([("2026-01-01T00:00:00Z", " 12 "), ("xZZ", "1.5"), (None, None), ("", "-7"), ("a", "1_0"), ("b", "9" * 30)], "t string, n string")
    assert [r[0] for r in df.select(time_text("t")).collect()] == ["2026-01-01T00:00:00", "xZ", "", "", "a", "b"]
    assert [int(r[0]) for r in df.select(lenient_int("n")).collect()] == [12, 0, 0, -7, 0, int("9" * 30)]
    two = spark.createDataFrame([("a", "9", "e"), ("a", "10", "e"), ("a", "10", "f")], "c string, g string, e string")
    assert two.agg(F.max(selection_key("c", "g", "e"))).first()[0].asDict() == {"created": "a", "tie": 10, "epoch": "f"}
    assert date_spine(spark, "2024-02-28", "2024-03-01").count() == 3
    with pytest.raises(ValueError):
        date_spine(spark, "2024-03-01", "2024-02-28")
    assert rows(id_ranges(spark, 10, 4), "low", "high") == [(0, 3), (4, 7), (8, 10)]
    with pytest.raises(ValueError):
        id_ranges(spark, 0, 4)


def test_apply_updates_and_summary(spark):
    base = spark.createDataFrame([("1", "a", 1, "x"), ("2", "a", 1, "x"), ("3", "b", 1, "x"), ("4", "b", 1, "x"), ("10", "a", 1, "x")], SCHEMA)
    new = spark.createDataFrame([("2", "b", 1, "y"), ("3", "b", 1, "x"), ("4", "a", 1, "y"), ("9", "a", 1, "z"), ("11", "a", 1, "z")], SCHEMA)
    found = merge.apply_updates(base, new, FEED)
    assert rows(found, "object_id", "name", "change") == sorted([("1", "x", "carried"), ("10", "x", "carried"), ("2", "y", "updated"), ("3", "x", "unchanged"), ("4", "x", "ignored_older"), ("9", "z", "new"), ("11", "z", "new")], key=str)
    s = merge.delta_summary(found, FEED).first()
    assert (s.deduped_count, s.new_count, s.updated_count, s.unchanged_count, s.ignored_older_count, s.carried_count) == (5, 2, 1, 1, 1, 2)
    assert s.new_ids == ["9", "11"]
    with pytest.raises(ValueError):
        merge.build_snapshot(base, new, FEED, "b", "b")


def test_maps_compare_by_content(spark):
    feed = Feed("object_id", "created")
    base = spark.createDataFrame([("1", "a", {"k": "1", "l": None})], "object_id string, created string, rec map<string,string>")
    new = spark.createDataFrame([("1", "a", {"l": None, "k": "1"})], "object_id string, created string, rec map<string,string>")
    assert rows(merge.apply_updates(base, new, feed), "change") == [("unchanged",)]


def history(seed, n=400, objects=12, days=15):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [(f"{rng.randrange(objects)}", start + dt.timedelta(seconds=rng.randrange(days * 24) * 3600), i, rng.choice("abc")) for i in range(n)]


TIMED = "object_id string, created timestamp_ntz, tie int, name string"


def state_before(data, cutoff, start=None):
    state = {}
    for r in data:
        if r[1] < cutoff and (start is None or r[1] >= start) and (r[0] not in state or (r[1], r[2]) > (state[r[0]][1], state[r[0]][2])):
            state[r[0]] = r
    return state


def test_roll_forward_equals_daily_steps(spark):
    data = history(1)
    df = spark.createDataFrame(data, TIMED)
    found = timeline.daily_states(timeline.versions(df, FEED), "2024-01-02", "2024-01-16")
    got = {}
    for r in found.collect():
        got.setdefault(r.snapshot_date, {})[r.object_id] = r.tie
    for d in range(2, 17):
        day = dt.date(2024, 1, d)
        assert got[day] == {k: v[2] for k, v in state_before(data, dt.datetime(2024, 1, d)).items()}
    step = timeline.as_of(df, FEED, F.lit("2024-01-02").cast("timestamp_ntz"))
    for d in range(3, 8):
        lo, hi = (F.lit(f"2024-01-0{x}").cast("timestamp_ntz") for x in (d - 1, d))
        step = merge.apply_updates(step, windows.latest(windows.in_window(df, FEED, lo, hi), FEED), FEED).drop("change")
    assert {r.object_id: r.tie for r in step.collect()} == got[dt.date(2024, 1, 7)]


def test_roll_forward_from_a_base_that_is_ahead(spark):
    at = dt.datetime(2024, 1, 3, 6)
    base = [("1", dt.datetime(2024, 1, 5, 1), 900, "base"), ("2", dt.datetime(2024, 1, 2), 901, "base")]
    data = [("1", dt.datetime(2024, 1, 3, 7), 1, "x"), ("2", dt.datetime(2024, 1, 3, 5), 2, "early"), ("2", dt.datetime(2024, 1, 3, 8), 3, "y"), ("1", dt.datetime(2024, 1, 6), 4, "z")]
    found = timeline.versions(spark.createDataFrame(data, TIMED), FEED, spark.createDataFrame(base, TIMED), "2024-01-03", at)
    got = {(str(r.snapshot_date), r.object_id): r.name for r in timeline.daily_states(found, "2024-01-03", "2024-01-07").collect()}
    assert got[("2024-01-04", "1")] == "base" and got[("2024-01-06", "1")] == "base" and got[("2024-01-07", "1")] == "z"
    assert got[("2024-01-03", "2")] == "base" and got[("2024-01-04", "2")] == "y"


def test_resume_over_archived_days(spark):
    data = history(2)
    df = spark.createDataFrame(data, TIMED)
    archived = {d: state_before(data, dt.datetime(2024, 1, d)) for d in (2, 6, 7, 12)}
    archived[6].pop(next(iter(archived[6])))  # what an archived day holds counts, even where a run would give another state
    snaps = [(*r, dt.date(2024, 1, d), dt.datetime(2024, 1, d)) for d, s in archived.items() for r in s.values()]
    snapshots = spark.createDataFrame(snaps, TIMED + ", snapshot_date date, state_as_of timestamp_ntz")
    found = timeline.daily_states(timeline.resume(df, FEED, snapshots), "2024-01-02", "2024-01-16")
    got = {}
    for r in found.collect():
        got.setdefault(r.snapshot_date.day, {})[r.object_id] = r.tie
    state = {}
    for d in range(2, 17):
        if d in archived:
            state = dict(archived[d])
        else:
            for k, r in state_before(data, dt.datetime(2024, 1, d), dt.datetime(2024, 1, d - 1)).items():
                if k not in state or (r[1], r[2]) > (state[k][1], state[k][2]):
                    state[k] = r
        assert got[d] == {k: v[2] for k, v in state.items()}, d


def test_replay_windows(spark):
    data = history(3, days=6)
    end = dt.datetime(2024, 1, 5, 12)
    found = {r.window_date: r for r in timeline.replay_windows(spark.createDataFrame(data, TIMED), FEED, dt.datetime(2024, 1, 1), end).collect()}
    seen = set()
    for d in range(1, 6):
        lo, hi = dt.datetime(2024, 1, d), min(dt.datetime(2024, 1, d + 1), end)
        inside = [r for r in data if lo <= r[1] < hi]
        ids = {r[0] for r in inside}
        r = found[lo.date()]
        assert (r.raw_rows, r.deduped, r.applied, r.ignored, r.objects_before, r.objects_after) == (len(inside), len(ids), len(ids), 0, len(seen), len(seen | ids))
        seen |= ids


def test_streaks_equal_day_by_day_audits(spark):
    rng = random.Random(4)
    days = [dt.date(2024, 1, d) for d in range(1, 15)]
    audited = [d for d in days if d.day not in (4, 9)]
    archived = [(d, str(o)) for d in days for o in range(8) if not (o == 7 and d.day == 6)]
    observed = [(d, o) for d, o in archived if rng.random() < 0.6]
    at = {d: f"{d}T06:00:00Z" for d in audited}
    found = visibility.streaks(*(spark.createDataFrame(x, s) for x, s in ((archived, "date date, object_id string"), (observed, "date date, object_id string"), (list(at.items()), "date date, observed_at string"))))
    got = {(r.date, r.object_id): (r.present, r.missing_days, r.first_missing, r.reappeared, r.missing_since) for r in found.collect()}
    prior, want = {}, {}
    for d in days:
        if d not in at:
            prior = {}
            continue
        state = {}
        for o in [o for x, o in archived if x == d]:
            if (d, o) in observed:
                want[d, o] = (True, 0, None, o in prior, prior[o][0] if o in prior else None)
            else:
                state[o] = (prior[o][0], prior[o][1] + 1) if o in prior else (at[d], 1)
                want[d, o] = (False, state[o][1], state[o][0], False, None)
        prior = state
    assert got == want


def test_audit_day(spark):
    archived = spark.createDataFrame([("1", "ONE"), ("2", "TWO"), ("3", "THREE")], "object_id string, name string")
    seen = spark.createDataFrame([("2",), ("9",)], "object_id string")
    before = spark.createDataFrame([("2", "d0", 2, None), ("3", "d0", 4, "s")], "object_id string, first_missing string, missing_days int, last_seen string")
    got = {r.object_id: (r.present, r.reappeared, r.missing_since, r.first_missing, r.missing_days, r.last_seen) for r in visibility.audit_day(archived, seen, before, "d1").collect()}
    assert got == {"1": (False, False, None, "d1", 1, None), "2": (True, True, "d0", None, None, None), "3": (False, False, None, "d0", 5, "s")}
    assert rows(visibility.unknown(seen, archived, ["object_id"]), "object_id") == [("9",)]


def test_dates(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-05",), ("2024-01-05",)], "date string").select(F.to_date("date").alias("date"))
    assert str(timeline.next_date(days, "2024-01-31").first()[0]) == "2024-01-06"
    assert str(timeline.next_date(days, "2024-01-03").first()[0]) == "2024-01-03"
    assert str(timeline.next_date(days.where("1 = 0"), "2024-01-03").first()[0]) == "2024-01-03"
    assert timeline.latest_dates(days, 0).count() == 0 and timeline.latest_dates(days, 5).count() == 2


def test_upkeep(spark):
    days = spark.createDataFrame([(f"2024-01-0{d}",) for d in (1, 2, 3, 4)], "date string")
    assert rows(maintenance.retention(days, 2), "date", "action")[1:3] == [("2024-01-02", "pruned"), ("2024-01-03", "retained")]
    assert rows(maintenance.retention(days, 0, days.where("date > '2024-01-02'")), "action") == [("pruned",), ("pruned",), ("skipped",), ("skipped",)]
    assert rows(maintenance.status_counts(maintenance.retention(days, 1)), "action", "n") == [("pruned", 3), ("retained", 1)]
    assert rows(maintenance.restore(days, days.limit(0), latest=1), "date", "action") == [("2024-01-04", "restore")]
    with pytest.raises(ValueError):
        maintenance.restore(days, days, latest=-1)
    assert maintenance.to_write(days, days).count() == 0 and maintenance.to_write(days, days, force=True).count() == 4


def test_publication(spark):
    bundles = spark.createDataFrame([("d1", "h1"), ("d2", "h2"), ("d3", "h3")], "date string, bundle_sha256 string")
    receipts = spark.createDataFrame([("d1", "a", "h1", 1), ("d2", "a", "old", 1), ("d3", "b", "h3", 1)], "date string, destination string, bundle_sha256 string, updated_at long")
    plan = lambda **o: [s for _, s in rows(maintenance.publish_ledgered(bundles, receipts, "a", **o), "date", "status")]
    assert plan() == ["skipped", "uploaded", "uploaded"]
    assert plan(force=True) == plan(policy="always_mirror") == ["uploaded"] * 3
    assert plan(policy="never") == ["upload_disabled"] * 3
    releases = spark.createDataFrame([("d1", True), ("d2", False)], "date string, has_asset boolean")
    plan = lambda **o: [s for _, s in rows(maintenance.publish_released(bundles, releases, **o), "date", "status")]
    assert plan() == ["skipped", "uploaded", "created"]
    assert plan(prerelease=True) == ["metadata_updated", "uploaded", "created"]
    assert plan(force=True) == plan(force=True, prerelease=True) == ["uploaded", "uploaded", "created"]
    merged = maintenance.merge_receipts(receipts, spark.createDataFrame([("d1", "a", "new", 1), ("d1", "c", "x", 0)], receipts.schema))
    assert rows(merged, "date", "destination", "bundle_sha256") == [("d1", "a", "new"), ("d1", "c", "x"), ("d2", "a", "old"), ("d3", "b", "h3")]
    nested = {r.date: {k: v.bundle_sha256 for k, v in r.destinations.items()} for r in maintenance.nested_receipts(merged).collect()}
    assert nested["d1"] == {"a": "new", "c": "x"}
