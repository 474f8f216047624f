"""Catalog files as streams, and days that become visible at once."""

import gzip
import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import canonical
from tidemark.plans import archives
from tidemark.sources import catalogs, days

dumps = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"))


def cut(data: bytes, sizes=(1,), required=("a",)):
    """Facts and records, with the data handed over in pieces."""
    cutter, out, at, k = catalogs.Cutter("id", required), [], 0, 0
    while at < len(data):
        n = sizes[k % len(sizes)]
        out += [dict(r) for r in cutter.feed(data[at : at + n])]
        at, k = at + n, k + 1
    cutter.finish()
    return cutter.facts(), out


TEXT = st.text(alphabet='{}[]",:\\ aé\U0001f600\x00\n', max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.dictionaries(TEXT, st.one_of(st.none(), TEXT), max_size=4), max_size=4))
def test_records_of_any_text(rows):
    data = dumps(rows).encode()
    # pieces end behind a brace, as the reader cuts them: an escape is never divided
    cutter, got = catalogs.Cutter("id", ()), []
    parts = data.split(b"}")
    for p in parts[:-1]:
        got += [dict(r) for r in cutter.feed(p + b"}")]
    got += [dict(r) for r in cutter.feed(parts[-1])]
    cutter.finish()
    facts = cutter.facts()
    assert got == rows and facts["readable"] and facts["canonical"] and facts["objects"] == len(rows)
    assert (facts["sha256"], facts["raw_bytes"]) == (hashlib.sha256(data).hexdigest(), len(data))


@pytest.mark.parametrize("text", ["", "[", "{}", "[1]", '["a"]', "[{}", "[{},]", "[{}{}]", "[[{}]]", '[{"a":}]', "[{}]]", "[{}] x", "no catalog", "[}", "{]", "[{}],[{}]", "]", "x" * 9000, "[" + "x" * 9000])
def test_what_is_no_list_of_records(text):
    facts, _ = cut(text.encode(), (7,))
    assert not facts["readable"] and facts["objects"] is None and facts["raw_bytes"] == len(text)


def test_facts():
    same = lambda text, **want: {k: cut(text.encode(), (1000,))[0][k] for k in want} == want
    assert same("[]", readable=True, canonical=True, objects=0, ordered=True, incomplete=False)
    assert same(' [ {"a" : "1"} ,\n{} ] ', readable=True, canonical=False, objects=2, incomplete=True)
    assert same('[{"a":"1","id":"10"},{"a":"1","id":"9"}]', canonical=True, ordered=False, incomplete=False)
    assert same('[{"b":"1","a":"1"}]', canonical=False)
    assert cut(b'[{"a":1.50,"b":true,"c":{"x":[1,"\\u00e9"]},"d":null,"e":"1"}]', (1000,))[1] == [{"a": "1.50", "b": "true", "c": '{"x":["1","é"]}', "d": None, "e": "1"}]


def files(root):
    return sorted(p for p in root.rglob("*.gz"))


def test_gzip_files_through_spark(spark, tmp_path):
    rng = random.Random(8)
    want, paths = {}, []
    for k in range(5):
        rows = [{"id": str(i), "a": rng.choice([None, "é}", '{"', "\\"])} for i in range(k * 700)]
        paths.append(str(tmp_path / f"{k}.json.gz"))
        with gzip.open(paths[-1], "wb") as f:
            f.write(dumps(rows).encode())
        want[k] = rows
    cut_off = tmp_path / "5.json.gz"
    cut_off.write_bytes(open(paths[4], "rb").read()[:-400])
    twice = tmp_path / "6.json"
    twice.write_text('[{"a":"1","id":"3"},{"a":"2","id":"3"}]')
    number = lambda p: int(p.rsplit("/", 1)[1].split(".")[0])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = catalogs.catalog_rows(spark, paths, "id").collect()
        facts = {number(r.path): r for r in catalogs.catalog_facts(spark, [*paths, str(cut_off), str(twice)], "id", ("a",)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, kept in want.items():
        assert [r.rec for r in sorted(rows, key=lambda r: r.pos) if number(r.path) == k] == kept
        data = dumps(kept).encode()
        c = facts[k].catalog
        assert (c.readable, c.sha256, c.raw_bytes, c.canonical, c.objects, c.repeats, c.ordered, c.incomplete) == (True, hashlib.sha256(data).hexdigest(), len(data), True, len(kept), False, True, False)
        assert facts[k].compressed_bytes == len(open(paths[k], "rb").read()) != len(data)
    assert not facts[5].catalog.readable
    assert facts[6].catalog.readable and facts[6].catalog.repeats


def test_days_are_visible_at_once(spark, tmp_path):
    root, kind = str(tmp_path / "archive"), "date string, name string, text string"
    write = lambda rows: days.write_days(spark.createDataFrame(rows, kind), root)
    shown = lambda: {(r.date, r.name): open(r.path).read() for r in days.visible(spark, root).collect()}
    assert days.visible(spark, root).count() == 0
    write([("2024-01-01", "manifest.json", "{}"), ("2024-01-01", "audit.json", "a"), ("2024-01-02", "manifest.json", "é")])
    before = {("2024-01-01", "manifest.json"): "{}", ("2024-01-01", "audit.json"): "a", ("2024-01-02", "manifest.json"): "é"}
    assert shown() == before
    # a run that ends between its files shows nothing: as files without a commit record, and as a job that fails in one task
    spark.dataSource.register(days.Days)
    writer = days.DayWriter(root, (), "unfinished")
    batch = spark.createDataFrame([("2024-01-01", "manifest.json", 0, 0, "half")], days._INPUT).toArrow().to_batches()
    writer.write(iter(batch))
    assert shown() == before
    with pytest.raises(Exception, match="no name"):
        write([("2024-01-01", "manifest.json", "other"), ("2024-01-02", None, "x")])
    assert shown() == before
    write([("2024-01-01", "manifest.json", "{1}")])
    after = {("2024-01-01", "manifest.json"): "{1}", ("2024-01-02", "manifest.json"): "é"}
    assert shown() == after
    assert days.vacuum(spark, root) == 0 and days.vacuum(spark, root, hours=0) == 3
    assert shown() == after and days.vacuum(spark, root, hours=0) == 0


def test_a_day_in_pieces_is_one_file(spark, tmp_path):
    rows = [("2024-01-0" + str(1 + i % 2), str(i), {"id": str(i), "v": "é" * (i % 5)}) for i in range(500)]
    df = spark.createDataFrame(rows, "date string, object_id string, rec map<string,string>").repartition(5)
    pieces = canonical.text_pieces(df, "object_id", "rec", ["date"], size=300).withColumn("name", days.F.lit("catalog.json.gz")).withColumnRenamed("shard", "part")
    root = str(tmp_path / "archive")
    run = days.stage_days(pieces, root, lists=("catalog.json.gz",))
    waiting = {r.date: r for r in days.staged(spark, root, run).collect()}
    assert days.visible(spark, root).count() == 0
    days.write_days(spark.createDataFrame([(d, "manifest.json", r.sha256) for d, r in waiting.items()], "date string, name string, text string"), root, staged=(run,))
    assert {(r.date, open(r.path).read()) for r in days.visible(spark, root).where("name = 'manifest.json'").collect()} == {(d, r.sha256) for d, r in waiting.items()}
    known = {r.date: r for r in canonical.table_hash(df, "object_id", "rec", ["date"]).collect()}
    for r in days.visible(spark, root).where("name like '%.gz'").collect():
        data = open(r.path, "rb").read()
        text = gzip.decompress(data)
        assert text == dumps([x for d, _, x in rows if d == r.date]).encode()
        assert (r.bytes, r.raw_bytes, r.sha256) == (len(data), len(text), hashlib.sha256(text).hexdigest()) and r.sha256 == known[r.date].sha256


def test_large_pieces_reach_the_writer_in_small_batches(spark, tmp_path, monkeypatch):
    """A task holds a few pieces of a large file, not all of them, and the file is whole."""
    from tidemark.sources.shared import BATCH_BYTES

    seen, write = str(tmp_path / "seen"), days.DayWriter.write

    def told(self, iterator):
        def each():
            for batch in iterator:
                with open(seen, "a") as f:
                    f.write(f"{batch.nbytes}\n")
                yield batch

        return write(self, each())

    monkeypatch.setattr(days.DayWriter, "write", told)
    pieces = spark.range(60).selectExpr("'2024-01-01' as date", "'catalog.json.gz' as name", "0 as part", "cast(id as int) as seq", "repeat(cast(id % 10 as string), 1000000) as text")
    days.write_days(pieces, str(tmp_path / "archive"))
    sizes = [int(n) for n in open(seen)]
    assert sum(sizes) > 60_000_000 and max(sizes) < 2 * BATCH_BYTES
    shown = days.visible(spark, str(tmp_path / "archive")).first()
    assert shown.sha256 == hashlib.sha256(b"".join(b"%d" % (k % 10) * 1_000_000 for k in range(60))).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.dictionaries(TEXT, st.one_of(st.none(), TEXT, st.integers(), st.lists(TEXT, max_size=2)), max_size=4), max_size=4), st.sampled_from(["", " ", '"', "x", "]", "{", "}"]), st.integers(0, 40), st.sampled_from([",", ", ", ",,", ""]))
def test_plain_records_need_no_tokens(rows, odd, at, comma):
    """Records that are taken whole give what the tokens give, in sound lists and in damaged ones."""
    data = ("[" + comma.join(dumps(r) for r in rows) + "]").encode()
    data = data[:at] + odd.encode() + data[at:]
    told = []
    for plain in (True, False):
        cutter, got = catalogs.Cutter("id", ("a",)), []
        if not plain:
            cutter._is_plain = lambda data: False
        parts = data.split(b"}")
        for p in parts[:-1]:
            got += list(cutter.feed(p + b"}"))
        got += list(cutter.feed(parts[-1]))
        cutter.finish()
        told.append((cutter.facts(), got))
    assert told[0] == told[1]
    assert catalogs.Cutter._is_plain(b',{"a":"b"}') and not catalogs.Cutter._is_plain(b',"x"{"a":"b"}')


def test_cuts_are_records_in_order(spark, tmp_path):
    want, paths = {}, []
    for k in range(4):
        paths.append(str(tmp_path / f"{k}.json.gz"))
        want[k] = dumps([{"id": str(i), "a": "é}"} for i in range(k * 40)])
        with gzip.open(paths[-1], "wb") as f:
            f.write(want[k].encode())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = catalogs.cuts(spark, paths).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, text in want.items():
        own = sorted((r.at, r.text) for r in rows if r.path.endswith(f"/{k}.json.gz"))
        assert [at for at, _ in own] == list(range(len(own))) and "".join(t for _, t in own) == text
        assert max(len(t) for _, t in own) < 40


def test_no_catalog_is_a_value_as_it_is_broken(spark, sf, monkeypatch):
    seen, write = [], days.write_days
    monkeypatch.setattr(days, "write_days", lambda texts, *a, **k: seen.append(texts) or write(texts, *a, **k))
    found = {r.date: r for r in archives._broken_days(spark, sf).collect()}
    longest = seen[0].where(F.col("name") == archives.CATALOG).groupBy("date").agg(F.max(F.length("text")).alias("one"), F.sum(F.length("text")).alias("all")).collect()
    assert all(r.one < 600 for r in longest) and max(r["all"] for r in longest) > 3000
    # lists of ids have their lengths alone
    assert any(r.delta and r.delta.updated_norad_cat_ids for r in found.values())
    assert not any(any(r.delta.updated_norad_cat_ids or []) for r in found.values() if r.delta)


def test_a_batch_of_pieces_is_small(spark):
    states = spark.range(3000).select(F.lit(1).alias("d"), "id", F.create_map(F.lit("a"), F.rpad(F.col("id").cast("string"), 200, "x")).alias("rec"))
    pieces = canonical.text_pieces(states, "id", "rec", ["d"])
    # Parquet readers take 4,096 rows at a time
    assert pieces.agg(F.max(F.length("text"))).first()[0] * 4096 <= 64 << 20
