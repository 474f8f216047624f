"""Queries over tables and files that they store first: partitioned history, validity ranges that late rows change, files by ranges, Merkle trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feed import EVENTS
from ..operators import merkle, timeline
from ..sources import days, files, history
from ..sources.shared import new_path

LOWER, UPPER, MOST, RANGE = "2024-01-05T00:00:00", "2024-01-20T12:00:00", 700, 100


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def history_ranges(spark, sf_dir):
    """A window of the history by id ranges, out of folders by day and by 50 ids."""
    path = new_path(spark, "history")
    rows = _events(spark, sf_dir)
    history.write_history(rows.where("event_id % 3 <> 0"), path, EVENTS, 50)
    history.write_history(rows.where("event_id % 3 = 0"), path, EVENTS, 50)
    found = history.history_ranges(spark, path, EVENTS, _time(LOWER), _time(UPPER), MOST, RANGE)
    return found.groupBy("range_low").agg(F.count("*").alias("rows"), F.count_distinct("user_id").alias("objects"), F.sum("event_id").alias("checksum"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last"))


def _time(text: str):
    from datetime import datetime

    return datetime.fromisoformat(text)


def versions_incremental(spark, sf_dir):
    """Ranges of two thirds of the events, then of the rest as late rows: some in one run, some with rows that are there already and rows without an object in another."""
    path = new_path(spark, "versions")
    rows = _events(spark, sf_dir)
    history.write_versions(timeline.versions(rows.where("event_id % 3 <> 0"), EVENTS), path, EVENTS, 32)
    late = rows.where("event_id % 3 = 0")
    history.update_versions(spark, path, late.where("event_id % 2 = 0"), EVENTS, 32)
    again = late.where("event_id % 2 = 1").union(rows.where("event_id % 4 = 1")).union(late.withColumn("user_id", F.lit(None).cast("long")))
    history.update_versions(spark, path, again, EVENTS, 32)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return history.read_versions(spark, path).select("user_id", "event_id", day("valid_from"), day("valid_to"))


def _text_files(spark, sf_dir, new: bool):
    """Documents as files of up to 500, by source; the new ones have some texts changed, and ends that grew or went."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    block = F.floor(F.col("doc_id") / 500)
    tail = F.col("doc_id") % 500 >= 480
    docs = docs.where(~(tail & (block % 2 == (0 if new else 1))))
    text = F.when(F.lit(new) & (F.col("doc_id") % 97 == 5), F.replace("text", F.lit("e"), F.lit("3"))).otherwise(F.col("text"))
    root = new_path(spark, "texts")
    name = F.concat_ws("-", F.coalesce("source", F.lit("none")), block.cast("string"))
    days.write_days(docs.select(F.lit("all").alias("date"), name.alias("name"), F.floor(F.col("doc_id") / 500).alias("part"), (F.col("doc_id") % 500).alias("seq"), text.alias("text")), root)
    found = files.chunk_hashes(days.visible(spark, root).select("path", "bytes"), 4096, 512)
    return found.withColumn("path", F.regexp_extract("path", r"[^/]+$", 0))


def merkle_file_roots(spark, sf_dir):
    return merkle.roots(_text_files(spark, sf_dir, False))


def merkle_diff(spark, sf_dir):
    trees = [merkle.Tree(_text_files(spark, sf_dir, new)) for new in (False, True)]
    return merkle.differences(*trees)[0]


def merkle_joint_proofs(spark, sf_dir):
    """One proof a file for a third of its chunks, checked, with the number of nodes that it holds."""
    tree = merkle.Tree(_text_files(spark, sf_dir, True))
    chosen = tree.spans.where("end > start and pos % 3 = 1")
    proof = merkle.joint_proof(tree, chosen)
    checked = merkle.check_joint_proof(chosen, proof, tree.level(99).select("path", F.lower(F.hex("id")).alias("root")))
    return checked.join(proof.groupBy("path").agg(F.count("id").alias("nodes")), "path")


def stream_state(spark, sf_dir):
    """The running state after two batches of events, with a start again from the checkpoint between them and after them; a row counts once."""
    from ..streaming.state import run_state

    root, rows = new_path(spark, "stream"), _events(spark, sf_dir)
    for part, where in (("a", "event_id % 2 = 0"), ("b", "event_id % 2 = 1"), (None, None)):
        if part:
            rows.where(where).write.parquet(f"{root}/in/{part}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        run_state(stream, EVENTS, f"{root}/out", f"{root}/log").awaitTermination()
    last = F.max_by(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "rows_seen"), "batch").alias("s")
    return spark.read.parquet(f"{root}/out").groupBy("user_id").agg(last).select("user_id", "s.event_id", "s.ts", "s.rows_seen")


_FILES_SQL = """f{v} as (select coalesce(source, 'none') || '-' || cast(doc_id // 500 as varchar) as path, encode(string_agg(coalesce({text}, ''), '' order by doc_id)) as b from documents
    where not (doc_id % 500 >= 480 and (doc_id // 500) % 2 = {gone}) group by 1),
  s{v} as (select *, octet_length(b) as n, octet_length(b) // 4096 as whole, octet_length(b) % 4096 as rest from f{v} where octet_length(b) > 0),
  k{v} as (select *, case when whole >= 1 and rest > 0 and rest < 512 then (4096 + rest + 1) // 2 end as cut, unnest(range(0, whole + 1)) as pos from s{v}),
  c{v} as (select path, pos, n, a, z, sha256(b[a + 1:z]) as h from (select path, n, pos, b, case when cut is not null and pos = whole then (whole - 1) * 4096 + cut else pos * 4096 end as a, case when cut is not null and pos = whole - 1 then pos * 4096 + cut else least((pos + 1) * 4096, n) end as z from k{v}) t)"""
_OLD_SQL = _FILES_SQL.format(v=0, text="text", gone=1)
_NEW_SQL = _FILES_SQL.format(v=1, text="case when doc_id % 97 = 5 then replace(text, 'e', '3') else text end", gone=0)
#: Layers of as many nodes as files of 4,096 chunks need.
_LAYERS_SQL = "l0 as (select path, pos, unhex(sha256(unhex(sha256(unhex(h))) || unhex(sha256(unhex(lpad(hex(z), 64, '0')))))) as id, z from c0)" + "".join(
    f", l{i + 1} as (select path, pos // 2 as pos, case when count(*) = 1 then arg_min(id, pos) else unhex(sha256(unhex(sha256(arg_min(id, pos))) || unhex(sha256(arg_max(id, pos))) || unhex(sha256(unhex(lpad(hex(min(z)), 64, '0')))))) end as id, max(z) as z from l{i} group by path, pos // 2)"
    for i in range(12)
)

ORACLES = {
    "history_ranges": f"""select user_id // {RANGE} * {RANGE} as range_low, count(*) as rows, count(distinct user_id) as objects, cast(sum(event_id) as bigint) as checksum, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last
      from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20 12:00:00' and user_id between 0 and {MOST} group by 1""",
    "versions_incremental": """with d as (select user_id, event_id, cast(ts as date) + 1 as v from events where user_id is not null qualify row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) = 1)
      select user_id, event_id, strftime(v, '%Y-%m-%d') as valid_from, strftime(lead(v) over (partition by user_id order by v), '%Y-%m-%d') as valid_to from d""",
    "stream_state": """select user_id, arg_max(event_id, (ts, event_id)) as event_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as ts, count(*) as rows_seen from events where user_id is not null group by user_id""",
    "merkle_file_roots": f"with {_OLD_SQL}, {_LAYERS_SQL} select path, cast(z as bigint) as bytes, lower(hex(id)) as root from l12",
    "merkle_diff": f"""with {_OLD_SQL}, {_NEW_SQL} select path, cast(pos as bigint) as pos, cast(coalesce(c1.a, c0.a) as bigint) as start, cast(coalesce(c1.z, c0.z) as bigint) as "end", case when c0.path is null then 'added' when c1.path is null then 'removed' else 'changed' end as change
      from c0 full join c1 using (path, pos) where c0.h is distinct from c1.h or c0.z is distinct from c1.z""",
    "merkle_joint_proofs": f"""with {_NEW_SQL}, last as (select path, max(pos) as last from c1 group by path), chosen as (select path, pos, last from c1 join last using (path) where z > a and pos % 3 = 1),
      on_ as (select distinct path, i, pos >> i as p, last >> i as last from chosen, unnest(range(0, 20)) as t(i) where last >> i > 0),
      beside as (select o.path, o.i, xor(o.p, 1) as s from on_ o where xor(o.p, 1) <= o.last and not exists (select 1 from on_ x where x.path = o.path and x.i = o.i and x.p = xor(o.p, 1)))
      select path, true as ok, count(beside.s) as nodes from (select distinct path from chosen) c left join beside using (path) group by path""",
}
QUERIES = {f.__name__: f for f in (history_ranges, versions_incremental, stream_state, merkle_file_roots, merkle_diff, merkle_joint_proofs)}
