"""Partitioned history, ranges that late rows change, mergeable summaries, running state of a stream."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.feed import Feed
from tidemark.operators import profile, timeline
from tidemark.sources import history

FEED = Feed("id", "created", ("gp",))
KIND = "id long, created timestamp_ntz, gp long, v string"


def rows_of(seed, n, ids=12):
    rng = random.Random(seed)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.choice([0, 1, 700, 1440, 5000, 20000, 30000]) + rng.randrange(3))
    return [(rng.choice([None, *range(ids)]), at(), rng.randrange(3), rng.choice("ab")) for _ in range(n)]


def test_history_prunes_days_and_id_ranges(spark, tmp_path):
    rows = [r for r in rows_of(1, 800, 400) if r[0] is not None] + [(-5, dt.datetime(2024, 1, 3), 1, "n"), (None, dt.datetime(2024, 1, 3), 1, "n"), (5, None, 1, "n")]
    path = str(tmp_path / "history")
    df = spark.createDataFrame(rows, KIND)
    history.write_history(df.where("gp = 0 or id is null"), path, FEED, 50)
    history.write_history(df.where("gp <> 0 and id is not null"), path, FEED, 50)
    assert spark.read.parquet(path).count() == len(rows)
    lo, hi = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 15, 7)
    found = history.history_ranges(spark, path, FEED, lo, hi, 130, 40)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert all(x in filters for x in ("created_date", ">= 2024-01-02", "<= 2024-01-15", "id_bucket_50", "<= 2)"))
    want = Counter((r[0] // 40 * 40, *r) for r in rows if r[0] is not None and r[1] and lo <= r[1] < hi and 0 <= r[0] <= 130)
    assert Counter((r.range_low, r.id, r.created, r.gp, r.v) for r in found.collect()) == want
    with pytest.raises(ValueError):
        history.history_ranges(spark, path, FEED, lo, hi, 0, 40)


def test_history_of_many_ids_takes_few_folders(spark, tmp_path):
    ids = sorted({0, 1, 49, 50, 799, 800, 801, 1599, 1600, 1 << 40, (1 << 62) + 7, -1, -50, -51, -(1 << 40), *random.Random(8).sample(range(100_000), 1000)})
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 3), 1, "v") for i in ids], KIND)
    path = str(tmp_path / "history")
    history.write_history(df, path, FEED, 50)
    places = [(r.id, r.id_bucket_50) for r in spark.read.parquet(path).orderBy("id").collect()]
    assert [i for i, _ in places] == ids and [b for _, b in places] == sorted(b for _, b in places)
    assert len({b for i, b in places if 0 <= i < 100_000}) <= 80  # 2,000 ranges
    assert all(b == i // 50 for i, b in places if 0 <= i < 800)
    lo, hi = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)
    for most in (1, 49, 50, 799, 800, 1600, 54_321, 1 << 50):
        found = history.history_ranges(spark, path, FEED, lo, hi, most, 40)
        assert sorted(r.id for r in found.collect()) == [i for i in ids if 0 <= i <= most]


def test_late_rows_change_ranges_as_a_rebuild_would(spark, tmp_path):
    path, rows = str(tmp_path / "versions"), rows_of(2, 120)
    df = lambda part: spark.createDataFrame(part, KIND)
    told = lambda found: Counter(tuple(r) for r in found.select("id", "created", "gp", "v", "valid_from", "valid_to").collect())
    history.write_versions(timeline.versions(df(rows[:60]), FEED), path, FEED, 8)
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "versions").glob("id_hash=*/*.parquet")}
    one = next(r for r in rows if r[0] is not None)[0]
    assert history.update_versions(spark, path, df([r for r in rows[60:] if r[0] == one]), FEED, 8) == 1
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "versions").glob("id_hash=*/*.parquet")}
    assert len(untouched.items() & after.items()) >= len(untouched) - 1
    history.update_versions(spark, path, df([r for r in rows[60:] if r[0] != one]), FEED, 8)
    assert told(history.read_versions(spark, path)) == told(timeline.versions(df(rows), FEED))
    # rows that are there already, that lose, and none at all change nothing
    history.update_versions(spark, path, df(rows[::3]), FEED, 8)
    history.update_versions(spark, path, df([]), FEED, 8)
    assert told(history.read_versions(spark, path)) == told(timeline.versions(df(rows), FEED))


def test_late_rows_over_a_base(spark, tmp_path):
    path, rows = str(tmp_path / "versions"), rows_of(3, 100, 5)
    df = spark.createDataFrame(rows, KIND)
    base = spark.createDataFrame([(k, dt.datetime(2024, 1, 8), 9, "base") for k in range(4)], KIND)
    build = lambda part: timeline.versions(part, FEED, base, "2024-01-04", F.lit("2024-01-04").cast("timestamp_ntz"))
    told = lambda found: Counter(tuple(r) for r in found.select("id", "created", "gp", "v", "valid_from", "valid_to").collect())
    history.write_versions(build(df.where("gp = 0")), path, FEED, 4)
    history.update_versions(spark, path, df.where("gp <> 0"), FEED, 4, first="2024-01-04")
    assert told(history.read_versions(spark, path)) == told(build(df))


def test_gaps_by_buckets(spark):
    rng = random.Random(4)
    days = {d: sorted(rng.sample(range(-300, 900), rng.choice([1, 2, 40, 300]))) for d in "abcd"}
    df = spark.createDataFrame([(d, i) for d, ids in days.items() for i in ids + ids[:3]] + [("a", None)], "snapshot_date string, i long")
    for bucket in (1, 7, 100, 10_000):
        got = {r.snapshot_date: (r.present, r.missing, r.largest_gap) for r in profile.id_gap_changes(df, "i", bucket=bucket).collect()}
        assert got == {d: (len(ids), ids[-1] - ids[0] + 1 - len(ids), max([b - a - 1 for a, b in zip(ids, ids[1:])], default=0)) for d, ids in days.items()}


@pytest.mark.parametrize("kept", [2, 5, 50, 10_000])
def test_top_values_with_bounded_memory(spark, kept):
    """Skewed values, nearly equal ones, more values than are kept, nulls and ties: the report is that of a full count."""
    rng = random.Random(5)
    rows = [{"skewed": str(int(rng.paretovariate(0.7))), "even": str(rng.randrange(40)), "own": str(k), "few": rng.choice(["x", "y"]), "blank": rng.choice([None, ""])} for k in range(3000)]
    df = spark.createDataFrame([(r,) for r in rows], "rec map<string,string>").repartition(5)
    want = []
    for field in rows[0]:
        counts = Counter(r[field] for r in rows if r[field] is not None)
        want += [(field, k + 1, v, n) for k, (v, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert sorted(map(tuple, profile.top_values(df, 4, kept=kept).collect())) == sorted(want)
        if kept == 50:
            counted = profile.value_summaries(df, kept).where("value is not null").groupBy("field").count().collect()
            assert all(r["count"] <= 5 * 2 * kept for r in counted)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_state_store_stream(spark, tmp_path):
    """Changes a batch makes, a restart between batches, and objects that fall silent."""
    from tidemark.streaming.state import run_state

    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    batches = [
        [(1, at(1), 1, "a"), (1, at(1, 2), 1, "b"), (2, at(1), 5, "x"), (None, at(1), 1, "n")],
        [(1, at(1), 9, "late"), (2, at(1), 5, "x"), (3, at(2), 1, "c")],
        [(4, at(9), 1, "d")],
        [(1, at(9, 1), 1, "again"), (4, at(9), 2, "tie")],
    ]
    stream = lambda: spark.readStream.schema(KIND).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, KIND).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
        run_state(stream(), FEED, str(tmp_path / "out"), str(tmp_path / "log"), "2 days", 3 * 86_400_000).awaitTermination()
    got = {(r.id, r.gp, r.v, r.rows_seen, r.change) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 1, "b", 2, "new"), (2, 5, "x", 1, "new"), (1, 1, "b", 3, "ignored_older"), (2, 5, "x", 2, "unchanged"), (3, 1, "c", 1, "new"), (4, 1, "d", 1, "new"), (1, 1, "b", 3, "expired"), (2, 5, "x", 2, "expired"), (3, 1, "c", 1, "expired"), (1, 1, "again", 1, "new"), (4, 2, "tie", 2, "updated")}


def test_state_keeps_numbers_as_they_are(spark, tmp_path):
    """Longs beyond 2^53 beside nulls, and NaN, which is no null."""
    from tidemark.streaming.state import run_state

    big, kind = (1 << 53) + 1, "id long, created timestamp, gp long, v double, w long"
    rows = [(1, dt.datetime(2024, 1, 2), 1, float("nan"), big), (1, dt.datetime(2024, 1, 1), 2, 0.5, None), (2, dt.datetime(2024, 1, 1), big, None, big), (2, dt.datetime(2024, 1, 1), big - 1, 0.0, None)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    run_state(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), FEED, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert {(r.id, r.gp, str(r.v), r.w, r.rows_seen) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, 1, "nan", big, 2), (2, big, "None", big, 2)}
