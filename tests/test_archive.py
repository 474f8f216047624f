"""An archive on disk, one broken thing at a time, and what the audit rules say of it."""

import copy
import datetime as dt
import gzip
import hashlib
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.feed import Feed
from tidemark.operators import ledger, rules
from tidemark.schema import typed
from tidemark.sources import archive
from tidemark.streaming import daily

FIELDS = {"CREATION_DATE": "2026-04-12T05:00:00", "EPOCH": "2026-04-12T04:00:00", "MEAN_MOTION": "15.0", "ECCENTRICITY": "0.0001", "INCLINATION": "51.6", "RA_OF_ASC_NODE": "10.0", "ARG_OF_PERICENTER": "20.0", "MEAN_ANOMALY": "30.0"}


def dumps(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()


def record(i, **more):
    return {"NORAD_CAT_ID": str(i), "OBJECT_NAME": f"OBJÉCT {i}", "DECAY_DATE": None, **FIELDS, **more}


def day(date, records, **manifest):
    raw = dumps(records)
    packed = gzip.compress(raw, mtime=0)
    entry = {"date": date, "sha256": hashlib.sha256(raw).hexdigest(), "object_count": len(records), "raw_bytes": len(raw), "compressed_bytes": len(packed), "provenance": "genesis_from_gp", "query_strategy": "s", "archived_at": "t", "state_as_of_utc": date + "T00:00:00Z"}
    return {"catalog": packed, "manifest": entry | manifest}


GENESIS = "2026-04-12"


def genesis():
    return day(GENESIS, [record(1), record(9), record(10)])


def rolled(date, base):
    """A good rolling day with all artifacts."""
    out = day(date, [record(1), record(9), record(10), record(11)], provenance="rolling_gp_history_delta", base_snapshot_date=GENESIS, base_snapshot_sha256=base["manifest"]["sha256"], delta_window_start_utc="a", delta_window_end_utc="b")
    out["delta"] = {"date": date, "window_start_utc": "a", "window_end_utc": "b", "deduped_update_count": 2, "new_object_count": 1, "updated_object_count": 1, "unchanged_update_count": 0, "ignored_older_update_count": 0, "new_norad_cat_ids": ["11"], "updated_norad_cat_ids": ["1"], "unchanged_update_norad_cat_ids": [], "ignored_older_update_norad_cat_ids": []}
    missing = {"norad_cat_id": "9", "object_name": "n", "last_gp_creation_date": "c", "first_missing_in_current_gp_audit": "o", "consecutive_missing_audits": 1}
    out["audit"] = {"date": date, "observed_at_utc": "o", "archive_object_count": 4, "missing_from_current_gp_count": 1, "present_in_current_gp_not_in_archive_count": 1, "reappeared_in_current_gp_count": 0, "missing_from_current_gp": [missing], "present_in_current_gp_not_in_archive": ["77"], "reappeared_in_current_gp": []}
    out["visibility"] = {"date": date, "observed_at_utc": "o", "missing_objects": {"9": missing | {"last_seen_in_current_gp_audit": None}}}
    return out


def archive_of_two():
    first = genesis()
    return {GENESIS: first, "2026-04-13": rolled("2026-04-13", first)}


NAMES = {"manifest": "manifest.json", "delta": "delta.json", "audit": "audit.json", "visibility": "visibility_state.json"}


def write(root, days, entries=None):
    for date, parts in days.items():
        folder = os.path.join(root, "data", *date.split("-"))
        os.makedirs(folder)
        for name, file in NAMES.items():
            if name in parts:
                with open(os.path.join(folder, file), "w") as f:
                    f.write(parts[name] if isinstance(parts[name], str) else json.dumps(parts[name], indent=2))
        if "catalog" in parts:
            with open(os.path.join(folder, "catalog.json.gz"), "wb") as f:
                f.write(parts["catalog"])
    keys = (*ledger.REQUIRED, *ledger.OPTIONAL)
    if entries is None:
        entries = [{k: p["manifest"][k] for k in keys if k in p["manifest"]} for _, p in sorted(days.items()) if isinstance(p.get("manifest"), dict)]
    with open(os.path.join(root, "ledger.json"), "w") as f:
        json.dump(entries, f)
    return root


def broken(spark, tmp_path, days, entries=None, **options):
    root = write(str(tmp_path), days, entries)
    found = rules.archive_violations(archive.days(spark, root + "/data"), archive.ledger(spark, root + "/ledger.json"), **({"least": 1} | options))
    got = sorted((r.rule, r.date) for r in found.select("rule", "date").distinct().collect())
    shutil.rmtree(root)
    os.makedirs(root)
    return [rule for rule, _ in got]


def recatalog(parts, records=None, raw=None):
    raw = dumps(records) if raw is None else raw
    n = len(records) if records is not None else 4
    parts["catalog"] = packed = gzip.compress(raw, mtime=0)
    parts["manifest"] |= {"sha256": hashlib.sha256(raw).hexdigest(), "raw_bytes": len(raw), "compressed_bytes": len(packed), "object_count": n}
    parts["audit"]["archive_object_count"] = n


def change(part, **values):
    return lambda parts: parts[part].update(values)


def spoil(part):
    return lambda parts: parts.update({part: b"x" if part == "catalog" else "{nothing"})


#: What breaks which rules of a day that is good otherwise.
BREAKS = [
    ([], lambda parts: None),
    (["R04"], lambda parts: parts.update(catalog=gzip.compress(b"nothing"))),
    (["R05"], change("manifest", sha256="0")),
    (["R06"], lambda parts: recatalog(parts, raw=json.dumps([record(1), record(9), record(10), record(11)]).encode())),
    (["R07"], change("manifest", raw_bytes=1)),
    (["R08"], change("manifest", compressed_bytes=1)),
    (["R09", "R31"], change("manifest", object_count=5)),
    (["R10"], lambda parts: recatalog(parts, [record(1), {k: v for k, v in record(9).items() if k != "EPOCH"}])),
    (["R11"], lambda parts: recatalog(parts, [record(1), record(1)])),
    (["R12"], lambda parts: recatalog(parts, [record(10), record(9)])),
    (["R15"], lambda parts: parts.pop("delta")),
    (["R16"], spoil("delta")),
    (["R17"], change("delta", date="x")),
    (["R18"], change("delta", window_start_utc="x")),
    (["R19"], change("delta", window_end_utc="x")),
    (["R20"], change("delta", new_norad_cat_ids=[])),
    (["R21"], change("delta", updated_norad_cat_ids=None)),
    (["R22"], change("delta", unchanged_update_norad_cat_ids=["5"])),
    (["R23"], change("delta", ignored_older_update_norad_cat_ids=["5"])),
    (["R24"], change("delta", deduped_update_count=3)),
    (["R25"], change("manifest", provenance="genesis_from_gp")),
    (["R26"], change("manifest", provenance="other")),
    (["R29"], spoil("audit")),
    (["R30"], change("audit", date="x")),
    (["R32", "R39"], change("audit", missing_from_current_gp_count=2)),
    (["R33"], change("audit", present_in_current_gp_not_in_archive=[])),
    (["R34"], change("audit", reappeared_in_current_gp_count=1)),
    (["R35"], spoil("visibility")),
    (["R36"], change("visibility", date="x")),
    (["R37"], change("visibility", observed_at_utc="x")),
    (["R38"], change("visibility", missing_objects=None)),
    (["R39"], change("visibility", missing_objects={})),
    (["L09"], change("manifest", base_snapshot_date="2020-01-01")),
    (["L10"], change("manifest", base_snapshot_sha256="x")),
]


def test_every_day_rule(spark, tmp_path):
    days, want = {GENESIS: genesis()}, {}
    for k, (expected, breaks) in enumerate(BREAKS):
        date = str(dt.date(2026, 4, 13) + dt.timedelta(days=k))
        days[date] = rolled(date, days[GENESIS])
        breaks(days[date])
        if expected:
            want[date] = expected
    root = write(str(tmp_path), days)
    found = rules.archive_violations(archive.days(spark, root + "/data"), archive.ledger(spark, root + "/ledger.json"), least=1)
    got = {}
    for r in found.select("date", "rule").distinct().collect():
        got.setdefault(r.date, []).append(r.rule)
    assert {d: sorted(r) for d, r in got.items()} == want


def test_rules_with_options_and_of_the_ledger(spark, tmp_path):
    good = archive_of_two()
    check = lambda days, *a, **o: broken(spark, tmp_path, days, *a, **o)
    entries = [{k: p["manifest"][k] for k in (*ledger.REQUIRED, *ledger.OPTIONAL) if k in p["manifest"]} for p in good.values()]
    bare = copy.deepcopy(good)
    for part in ("catalog", "audit", "visibility"):
        bare["2026-04-13"].pop(part)
    assert check(bare, require_audit=True, latest_catalogs=1, least=4) == ["R10", "R13", "R27", "R27", "R28", "R28"]
    bare[GENESIS].pop("catalog")
    assert check(bare, least=4) == ["R14"]
    spoilt = copy.deepcopy(good)
    spoilt["2026-04-13"]["manifest"] = "{nothing"
    assert check(spoilt, entries) == ["L06", "R02"]
    wrong = copy.deepcopy(good)
    wrong["2026-04-13"]["manifest"]["date"] = "2026-04-20"
    assert check(wrong, entries) == ["L06", "R03"]
    assert check(good, [*entries, entries[0], "text"]) == ["L04", "L05", "L07"]
    assert check(good, [entries[1] | {"object_count": 9, "more": "allowed"}]) == ["L06", "L08"]


def test_missing_ledger_and_strict_mode(spark, tmp_path):
    root = write(str(tmp_path), archive_of_two())
    days = archive.days(spark, root + "/data")
    found = rules.archive_violations(days, None, least=1)
    assert [r.rule for r in found.collect()] == ["L01"]
    with pytest.raises(ValueError, match="L01"):
        rules.require_no_violations(found)
    rules.require_no_violations(found.limit(0))
    assert [r.rule for r in rules.ledger_violations(None, days.select("manifest.*"), readable=False).collect()] == ["L02"]
    assert [r.rule for r in rules.ledger_violations(None, days.select("manifest.*"), is_list=False).collect()] == ["L03"]
    assert "A01" in [r.rule for r in rules.archive_violations(days.limit(0), None).collect()]
    assert [str(r.date) for r in archive.discover(spark, root + "/data").collect()] == ["2026-04-12", "2026-04-13"]
    checked = days.select("date", rules.payload_problem().alias("p")).collect()
    assert {r.p for r in checked} == {None}
    inside = {r.date: r.files for r in archive.inventory(spark, root + "/data").collect()}
    path = root + "/data/2026/04/13/"
    assert [(f.path, f.bytes, f.sha256) for f in inside["2026-04-13"]] == [(n, os.path.getsize(path + n), hashlib.sha256(open(path + n, "rb").read()).hexdigest()) for n in sorted(os.listdir(path))]
    rows = archive.catalog(spark, path + "catalog.json.gz")
    assert {r.object_id: r.rec for r in rows.collect()} == {str(i): record(i) for i in (1, 9, 10, 11)}
    one = typed(rows).where("norad_cat_id = 9").first()
    assert (one.creation_date, float(one.inclination), one.decay_date) == (dt.datetime(2026, 4, 12, 5), 51.6, None)
    with pytest.raises(ValueError, match="below"):
        rules.require_valid(rows, 5)
    rules.require_valid(rows, 4)
    with pytest.raises(ValueError, match="9 misses fields: EPOCH"):
        rules.require_valid(rows.withColumn("rec", F.when(F.col("object_id") == "9", F.map_filter("rec", lambda k, v: k != "EPOCH")).otherwise(F.col("rec"))), 1)


def test_visibility_layouts(spark):
    item = {"norad_cat_id": "9", "consecutive_missing_audits": 2}
    texts = [json.dumps({"missing_objects": {"9": item}}), json.dumps({"objects": {"9": item | {"currently_missing_from_current_gp": True}, "8": item | {"currently_missing_from_current_gp": False}}}), "[]", "{}"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(archive.previous_visibility("text").alias("m")).collect()
    assert [sorted(r.m) for r in rows] == [["9"], ["9"], [], []]


def test_ledger(spark):
    entry = lambda date, sha: (date, sha, 1, 2, ledger.ROLLING, "s", "t", None, None, None, None, None)
    kind = "date string, sha256 string, object_count long, compressed_bytes long, provenance string, query_strategy string, archived_at string, state_as_of_utc string, base_snapshot_date string, base_snapshot_sha256 string, delta_window_start_utc string, delta_window_end_utc string"
    old = spark.createDataFrame([entry("d1", "a"), entry("d3", "c")], kind)
    first = ledger.upsert(old, spark.createDataFrame([entry("d2", "b"), entry("d3", "other")], kind), "now")
    rows = [(r.date, r.sha256, r.previous_sha256, r.regenerated_at) for r in first.collect()]
    assert rows == [("d1", "a", None, None), ("d2", "b", None, None), ("d3", "other", "c", "now")]
    again = ledger.upsert(first, spark.createDataFrame([entry("d3", "other")], kind), "later")
    assert [(r.date, r.previous_sha256) for r in again.collect()] == [("d1", None), ("d2", None), ("d3", None)]
    kept = ledger.upsert(first, spark.createDataFrame([entry("d4", "x")], kind), "later")
    assert [(r.date, r.previous_sha256) for r in kept.collect()][2] == ("d3", "c")


def test_snapshot_table_and_manifests(spark, tmp_path):
    rows = [(d, str(i), {"v": str(i + d)}) for d in (1, 2) for i in range(5)]
    df = spark.createDataFrame(rows, "d int, object_id string, rec map<string,string>").selectExpr("object_id", "rec", "date_add(date '2024-01-01', d) as snapshot_date")
    path = str(tmp_path / "t")
    archive.write_snapshots(df, path)
    archive.write_snapshots(df.where("snapshot_date = '2024-01-03'").limit(2), path)
    assert {str(r.snapshot_date): r.n for r in spark.read.parquet(path).groupBy("snapshot_date").agg(F.count("*").alias("n")).collect()} == {"2024-01-02": 5, "2024-01-03": 2}
    found = archive.manifests(df).orderBy("date").collect()
    assert [r.sha256 for r in found] == [hashlib.sha256(dumps([r[2] for r in rows if r[0] == d])).hexdigest() for d in (1, 2)]
    assert [r.base_snapshot_sha256 for r in found] == [None, found[0].sha256]
    assert [r.value for r in archive.catalog_lines(df.where("snapshot_date = '2024-01-02'")).collect()] == [dumps(r[2]).decode() for r in rows if r[0] == 1]


def test_stale_artifacts_and_genesis(spark):
    kind = "date string, n int"
    table, rows = spark.createDataFrame([("d1", 1), ("d2", 1), ("d3", 1)], kind), spark.createDataFrame([("d2", 2), ("d9", 9)], kind)
    done = archive.replace_days(table, rows, spark.createDataFrame([("d2",), ("d3",)], "date string"))
    assert sorted(map(tuple, done.collect())) == [("d1", 1), ("d2", 2)]
    first = archive.genesis(spark.createDataFrame([("1",), (None,)], "object_id string"), "2026-04-12", "2026-04-12T06:00:00").collect()
    assert [(r.object_id, str(r.snapshot_date), r.state_as_of) for r in first] == [("1", "2026-04-12", dt.datetime(2026, 4, 12, 6))]


def test_history_and_bundles(spark):
    feed = Feed("object_id", "created")
    df = spark.createDataFrame([("5", "b"), ("15", "b"), ("25", "b"), ("7", "z"), ("-1", "b")], "object_id string, created string")
    assert sorted((r.object_id, r.range_low) for r in archive.history(df, feed, "a", "c", 20, 10).collect()) == [("15", 10), ("5", 0)]
    with pytest.raises(ValueError):
        archive.history(df, feed, "a", "c", 0, 10)
    bundles = spark.createDataFrame([("d1", "a", 1), ("d2", "x", 1), ("d3", "a", 1), ("d4", "a", 2)], "date string, catalog_sha256 string, object_count int")
    manifests = spark.createDataFrame([("d1", "a", 1), ("d2", "a", 1), ("d4", "a", 1)], "date string, sha256 string, object_count int")
    assert sorted((r.date, r.problem) for r in rules.bundle_problems(bundles, manifests).collect()) == [("d2", "sha256"), ("d3", "no manifest"), ("d4", "object_count")]


def test_stream_drops_what_comes_after_its_day(spark, tmp_path):
    feed = Feed("object_id", "created", ("tie",))
    kind = "object_id string, created timestamp_ntz, tie int"
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda rows: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
    run = lambda: daily.run_daily(spark.readStream.schema(kind).parquet(source), feed, out, str(tmp_path / "log")).awaitTermination()
    put([("1", at(1, 1), 1), ("1", at(1, 2), 2), ("2", at(1, 3), 3), ("1", at(2, 1), 4)])
    run()
    put([("1", at(3, 1), 5)])
    run()
    put([("2", at(1, 23), 6), ("1", at(4, 1), 7)])  # the first is late: its day is closed
    run()
    got = {(str(r.window_date), r.object_id): r.tie for r in spark.read.schema("object_id string, created timestamp_ntz, tie int, window_date date").parquet(out).collect()}
    assert got == {("2024-01-01", "1"): 2, ("2024-01-01", "2"): 3, ("2024-01-02", "1"): 4, ("2024-01-03", "1"): 5}


def test_state_folds_batches_once(spark, tmp_path):
    feed = Feed("object_id", "created", ("tie",))
    step = daily.fold_state(feed, str(tmp_path))
    kind = "window_date string, object_id string, created string, tie int"
    batches = [spark.createDataFrame([("a", "1", "a", 1), ("b", "1", "b", 2), ("a", "2", "a", 1)], kind), spark.createDataFrame([("c", "2", "c", 5)], kind)]
    for n, b in enumerate(batches):
        step(b, n)
        step(b, n)
    assert sorted((r.object_id, r.tie) for r in spark.read.parquet(f"{tmp_path}/1").collect()) == [("1", 2), ("2", 5)]


def test_ledger_texts_of_several_archives(spark):
    entry = lambda date, sha="s", base="null": f'{{"date":"{date}","sha256":"{sha}","object_count":5,"compressed_bytes":1,"provenance":"p","query_strategy":"q","archived_at":"t","base_snapshot_date":{base}}}'
    a, b = entry("2024-01-01"), entry("2024-01-02")
    schema = "archive string, date string, sha256 string, object_count long, compressed_bytes long, provenance string, query_strategy string, archived_at string, base_snapshot_date string, base_snapshot_sha256 string"
    row = lambda archive, date: (archive, date, "s", 5, 1, "p", "q", "t", None, None)
    manifests = spark.createDataFrame([row(k, d) for k in ("fine", "none", "cut", "value", "short", "swapped", "other") for d in ("2024-01-01", "2024-01-02")], schema)
    texts = [("fine", f"[{a},{b}]"), ("cut", f"[{a},"), ("value", a), ("short", f"[{a}]"), ("swapped", f"[{b},{a}]"), ("other", f"[{a},{entry('2024-01-02', 'x')}]"), ("stray", f"[{a}]")]
    frame = spark.createDataFrame(texts, "archive string, text string")
    found = {(r.archive, r.rule, r.date) for r in rules.ledger_text_violations(frame, manifests, ("archive",)).collect()}
    assert found == {("none", "L01", None), ("cut", "L02", None), ("value", "L03", None), ("short", "L06", "2024-01-02"), ("swapped", "L05", "2024-01-01"), ("other", "L08", "2024-01-02"), ("stray", "L06", "2024-01-01")}
    for archive in ("none", "cut", "swapped"):  # alone, without keys
        alone = frame.where(F.col("archive") == archive).select("text")
        one = rules.ledger_text_violations(alone, manifests.where(F.col("archive") == archive).drop("archive")).collect()
        assert {(archive, r.rule, r.date) for r in one} == {x for x in found if x[0] == archive}
    # manifests of another archive are no base
    chained = spark.createDataFrame([("x", "2024-01-01", "s", 5, 1, "p", "q", "t", None, None), ("y", "2024-01-02", "s", 5, 1, "rolling_gp_history_delta", "q", "t", "2024-01-01", "s")], schema)
    assert [r.rule for r in ledger.broken_links(chained, ("archive",)).collect()] == ["L09"] and not ledger.broken_links(chained).collect()
    empty = manifests.where("1 = 0")
    assert not rules.ledger_text_violations(frame.where("1 = 0"), empty, ("archive",)).collect()
    assert [r.rule for r in rules.ledger_text_violations(frame.where("1 = 0").select("text"), empty.drop("archive")).collect()] == ["L01"]
