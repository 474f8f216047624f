"""Reading and writing archives: catalogs as JSON text, day artifacts, file inventories, snapshot tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..feed import Feed
from ..functions.canonical import canonical_text, table_hash
from ..functions.scalars import id_ranges, lenient_int
from ..operators.ledger import GENESIS, ROLLING
from ..operators.rules import catalog_facts as text_facts
from ..operators.rules import require_valid
from .catalogs import catalog_facts
from .days import visible
from .shared import stored

#: The files of a day that belong to a bundle.
ARTIFACTS = ("catalog.json.gz", "manifest.json", "delta.json", "audit.json", "visibility_state.json")
_DAY, _KEYED = r"(\d{4})/(\d{2})/(\d{2})/[^/]+$", r"/date=(\d{4}-\d{2}-\d{2})/name=([^/]+)/[^/]+$"


def day_of(path):
    """The date that a file's folders year/month/day, or date=.../name=..., name; null if they name none."""
    parts = F.concat_ws("-", *[F.regexp_extract(path, _DAY, k) for k in (1, 2, 3)])
    keyed = F.regexp_extract(path, _KEYED, 1)
    return F.date_format(F.try_to_date(F.when(keyed != "", keyed).otherwise(parts), "yyyy-MM-dd"), "yyyy-MM-dd")


def name_of(path):
    """The name of an artifact: its folder name=..., else that of the file."""
    keyed = F.regexp_extract(path, _KEYED, 2)
    return F.when(keyed != "", keyed).otherwise(F.regexp_extract(path, r"[^/]+$", 0))


def write_files(files: DataFrame, root: str) -> None:
    """Write artifacts (date, name, text) as one text file each, under date=.../name=.... Days that are written are replaced whole, so no artifact of an earlier run stays.

    A text file ends with a line feed of its own.
    """
    rows = files.select(F.col("date").cast("string").alias("date"), "name", F.col("text").alias("value"))
    days = rows.select("date").distinct()
    out = rows.repartition("date", "name").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "name")
    try:
        old = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(day_of(F.col("path")).alias("date"), name_of(F.col("path")).alias("name"), "path")
        stale = old.join(days, "date", "left_semi").join(rows, ["date", "name"], "left_anti").select("path").collect()  # a few files for each day written
    except AnalysisException:  # nothing there yet
        stale = []
    out.text(root)
    sc = rows.sparkSession.sparkContext
    for row in stale:
        where = sc._jvm.org.apache.hadoop.fs.Path(row["path"]).getParent()
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(date, name, text, file_bytes) of what write_files() has written."""
    found = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return found.select(day_of(path).alias("date"), name_of(path).alias("name"), F.regexp_replace("value", r"\n\z", "").alias("text"), (F.col("_metadata.file_size") - 1).alias("file_bytes")).where("date is not null")


def texts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(date, path, text) of one artifact over all days; .gz files are unpacked by their codec."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(root, wholetext=True)
    return files.select(day_of(F.col("_metadata.file_path")).alias("date"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_bytes"), F.col("value").alias("text")).where("date is not null")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """(object_id, rec) rows of a catalog file: a JSON array of objects, null fields kept apart from missing ones."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("rec")).select(F.col("rec")["NORAD_CAT_ID"].alias("object_id"), "rec")


def history(df: DataFrame, feed: Feed, lower, upper, most: int, size: int) -> DataFrame:
    """Rows of a window with ids from 0 to most, by id ranges: (range_low, row). Ranges tag the rows; the scan is one.

    An id column of an integer type is compared as it is, so that both the window and the ids reach the Parquet scan; texts are read leniently.
    """
    if most < 1 or size < 1:
        raise ValueError("the largest id and the range size must be positive")
    whole = isinstance(df.schema[feed.id].dataType, T.IntegralType)
    number = F.col(feed.id) if whole else lenient_int(feed.id)
    rows = df.where((F.col(feed.created) >= F.lit(lower)) & (F.col(feed.created) < F.lit(upper)) & number.between(0, most))
    return rows.withColumn("range_low", (F.floor(number / size) * size).cast("long"))


def ranges(spark: SparkSession, most: int, size: int) -> DataFrame:
    return id_ranges(spark, most, size)


def observation(df: DataFrame, observed_at, at_col: str = "observed_at", id_col: str = "object_id") -> DataFrame:
    """One observation, sorted by id. With `record_col` at hand, pass the result through rules.require_valid before it is archived."""
    return df.where(F.col(at_col) == F.lit(observed_at)).orderBy(lenient_int(id_col), id_col)


def checked_observation(df: DataFrame, observed_at, least: int, at_col: str = "observed_at", id_col: str = "object_id", record_col: str = "rec") -> DataFrame:
    """observation(), or ValueError if it has fewer than `least` records or one without a required field."""
    found = observation(df, observed_at, at_col, id_col)
    require_valid(found, least, id_col, record_col)
    return found


def artifact(spark: SparkSession, root: str, name: str, kind: str) -> DataFrame:
    """(date, parsed, broken): a day's JSON artifact; one that is no JSON object is broken, with parsed null."""
    return parsed_artifact(texts(spark, root, name), kind)


def parsed_artifact(found: DataFrame, kind: str) -> DataFrame:
    """(date, parsed, broken) of texts (date, text)."""
    parsed = F.from_json("text", kind + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = found.withColumn("parsed", parsed).withColumn("broken", F.col("parsed").isNull() | F.col("parsed._bad").isNotNull())
    return rows.select("date", F.when(~F.col("broken"), F.col("parsed").dropFields("_bad")).alias("parsed"), "broken")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(date): days with a manifest, distinct and in order."""
    return texts(spark, root, "manifest.json").select("date").distinct().orderBy("date")


def previous_visibility(text: str = "text"):
    """A day's missing objects as a map: the present layout, or the older one with its objects that are missing; else an empty map."""
    now = F.from_json(text, f"missing_objects map<string,{schema.STATE}>")["missing_objects"]
    older = F.from_json(text, f"objects map<string,{schema.STATE[:-1]},currently_missing_from_current_gp:boolean>>")["objects"]
    missing = F.map_filter(older, lambda k, v: F.coalesce(v["currently_missing_from_current_gp"], F.lit(False)))
    same = F.transform_values(missing, lambda k, v: v.dropFields("currently_missing_from_current_gp"))
    return F.coalesce(now, same, F.from_json(F.lit("{}"), f"map<string,{schema.STATE}>"))


def days(spark: SparkSession, root: str) -> DataFrame:
    """One row for each day with a manifest, as the audit rules take it (see operators.rules)."""
    return _joined(*[texts(spark, root, name) for name in ARTIFACTS[1:]], texts(spark, root, ARTIFACTS[0]))


def days_of(files: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """days() of artifacts (date, name, text, file_bytes); with dates, a row for each of them, whether it has a manifest or not."""
    return _joined(*[files.where(F.col("name") == name) for name in (*ARTIFACTS[1:], ARTIFACTS[0])], dates=dates)


def written_days(spark: SparkSession, root: str, dates: DataFrame | None = None) -> DataFrame:
    """days_of() what days.write_days() has written: of each day the latest commit's files. Catalogs of any size are read as streams of records, see catalogs.catalog_facts(); of lists and maps of other artifacts only their lengths are kept, as arrays of nulls."""
    shown = stored(visible(spark, root).where(F.col("name").isin(*ARTIFACTS)), "visible")
    key = lambda c: F.regexp_extract(c, r"/(_files/.+)$", 1).alias("key")
    paths = {name: [r["path"] for r in shown.where(F.col("name") == name).select("path").collect()] for name in ARTIFACTS}  # a path a day
    named = shown.select("date", "name", key("path"))
    small = [p for name in ARTIFACTS[1:] for p in paths[name]]
    kind = "key string, text string, file_bytes long"
    texts = spark.read.text(small, wholetext=True).select(key("_metadata.file_path"), F.col("value").alias("text"), F.col("_metadata.file_size").alias("file_bytes")) if small else spark.createDataFrame([], kind)
    texts = named.join(texts, "key", "left").withColumn("text", F.coalesce("text", F.lit("")))
    found = catalog_facts(spark, paths[ARTIFACTS[0]]) if paths[ARTIFACTS[0]] else spark.createDataFrame([], f"path string, compressed_bytes long, catalog struct<readable:boolean,sha256:string,raw_bytes:long,canonical:boolean,objects:long,repeats:boolean,ordered:boolean,incomplete:boolean>")
    there = named.where(F.col("name") == ARTIFACTS[0]).join(found.select(key("path"), "compressed_bytes", "catalog"), "key", "left")
    # an empty file leaves no row to tell of it
    unread = F.struct(*[(F.lit(False) if f.name == "readable" else F.lit(None).cast(f.dataType)).alias(f.name) for f in found.schema["catalog"].dataType])
    cats = there.select("date", F.coalesce("compressed_bytes", F.lit(0)).alias("compressed_bytes"), F.coalesce("catalog", unread).alias("catalog"))
    return _joined(*[texts.where(F.col("name") == name) for name in ARTIFACTS[1:]], cats, dates=dates, lengths=True)


def _joined(manifests: DataFrame, deltas: DataFrame, audits: DataFrame, states: DataFrame, catalogs: DataFrame, dates: DataFrame | None = None, lengths: bool = False) -> DataFrame:
    """Catalogs come as texts, or with their facts as (date, compressed_bytes, catalog). With lengths, lists and maps are arrays of as many nulls, so that joins don't move a day's ids."""
    kinds = (("manifest", manifests, schema.MANIFEST), ("delta", deltas, schema.DELTA), ("audit", audits, schema.AUDIT), ("visibility", states, schema.VISIBILITY))
    parts = []
    for name, found, kind in kinds:
        part = parsed_artifact(found, kind).select("date", F.col("parsed").alias(name), F.col("broken").alias(f"{name}_broken"))
        fields = [(f.name, f.dataType) for f in part.schema[name].dataType]
        if lengths and any(isinstance(t, (T.ArrayType, T.MapType)) for _, t in fields):
            nulls = lambda c: F.transform(c, lambda x: F.lit(None).cast("boolean"))
            short = [(nulls(F.col(f"{name}.{f}")) if isinstance(t, T.ArrayType) else nulls(F.map_keys(f"{name}.{f}")) if isinstance(t, T.MapType) else F.col(f"{name}.{f}")).alias(f) for f, t in fields]
            part = part.withColumn(name, F.when(F.col(name).isNotNull(), F.struct(*short)))
        parts.append(part)
    cats = catalogs if "catalog" in catalogs.columns else catalogs.select("date", F.col("file_bytes").alias("compressed_bytes"), F.struct(*text_facts("text")).alias("catalog"))
    return reduce(lambda a, b: a.join(b, "date", "left"), [*([] if dates is None else [dates.select("date").distinct()]), *parts, cats]).na.fill(False, [f"{name}_broken" for name, _, _ in kinds])


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(position, entry fields) of a ledger file; entries that are no objects have a null date."""
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.posexplode(F.from_json("value", "array<string>")).alias("position", "e"))
    return rows.select("position", F.from_json("e", schema.ENTRY).alias("e")).select("position", "e.*")


def inventory(spark: SparkSession, root: str, names: tuple[str, ...] = ARTIFACTS, empty: DataFrame | None = None) -> DataFrame:
    """(date, files): the allow-listed files of each day as (path, bytes, sha256), in order of name.

    The binary source leaves out empty files; a caller that knows of some passes them as (date, name).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rows = files.select(day_of(F.col("path")).alias("date"), name_of(F.col("path")).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    if empty is not None:
        rows = rows.unionByName(empty.select("date", "name", F.lit(0).cast("long").alias("bytes"), F.sha2(F.lit("").cast("binary"), 256).alias("sha256")))
    rows = rows.where(F.col("date").isNotNull() & F.col("name").isin(*names))
    return rows.groupBy("date").agg(F.array_sort(F.collect_list(F.struct(F.col("name").alias("path"), "bytes", "sha256"))).alias("files"))


def write_snapshots(states: DataFrame, path: str, date_col: str = "snapshot_date") -> None:
    """States by day as a partitioned table; only the days in `states` are replaced. Spark sizes the files: large days are split, small ones share a task."""
    states.hint("rebalance", F.col(date_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)


def replace_days(table: DataFrame, rows: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """The table with the given days taken from rows instead; a day without rows there disappears, so no stale artifact stays."""
    return table.join(dates.select(date_col).distinct(), date_col, "left_anti").unionByName(rows.join(dates.select(date_col).distinct(), date_col, "left_semi"))


def genesis(observed: DataFrame, date: str, observed_at: str, id_col: str = "object_id") -> DataFrame:
    """The first snapshot, from an observation. Its state stands for the time of the observation, where the first window then starts."""
    first = observed.where(F.col(id_col).isNotNull())
    return first.withColumn("snapshot_date", F.lit(date).cast("date")).withColumn("state_as_of", F.lit(observed_at).cast("timestamp_ntz"))


#: What a manifest says of its format and origin.
FORMAT, SOURCE = "OMM/JSON", "space-track.org"


def manifests(states: DataFrame, id_col: str = "object_id", record_col: str = "rec", date_col: str = "snapshot_date", archived_at: str | None = None, strategy: str | None = None, version: str | None = None, genesis_at: str | None = None) -> DataFrame:
    """Manifests of daily states, each day linked to the one before by date, hash and window.

    A day's state stands for its midnight. With genesis_at, the time of an observation, the first day is a genesis: its state stands for that time, where the next
    day's window then begins. Otherwise the first day has no base. compressed_bytes is what an uncompressed file takes; see manifests_of() for written files.
    """
    hashed = table_hash(states, id_col, record_col, [date_col]).withColumn("date", F.date_format(date_col, "yyyy-MM-dd"))
    return manifests_of(hashed.withColumn("compressed_bytes", F.col("raw_bytes")), archived_at, strategy, version, genesis_at)


def manifests_of(hashed: DataFrame, archived_at: str | None = None, strategy: str | None = None, version: str | None = None, genesis_at: str | None = None) -> DataFrame:
    """manifests() of days whose catalogs are known as (date, objects, raw_bytes, compressed_bytes, sha256)."""
    days = Window.orderBy("date")  # one row for each day
    first = F.lag("date").over(days).isNull() & F.lit(genesis_at is not None)
    hashed = hashed.withColumn("_first", first).withColumn("as_of", F.when(F.col("_first"), F.lit(genesis_at)).otherwise(F.concat("date", F.lit("T00:00:00Z"))))
    raw = F.col("raw_bytes").cast("long")
    start = F.lag("as_of").over(days)
    return hashed.select(
        "date", F.col("as_of").alias("cutoff_utc"), F.col("as_of").alias("state_as_of_utc"), "sha256", F.col("objects").cast("long").alias("object_count"), raw.alias("raw_bytes"), F.col("compressed_bytes").cast("long").alias("compressed_bytes"),
        F.when(F.col("_first"), GENESIS).otherwise(ROLLING).alias("provenance"), F.lit(FORMAT).alias("format"), F.lit(SOURCE).alias("source"), F.lit(version).cast("string").alias("pipeline_version"), F.lit(strategy).cast("string").alias("query_strategy"),
        F.lit(archived_at).cast("string").alias("archived_at"), F.lag("date").over(days).alias("base_snapshot_date"), F.lag("sha256").over(days).alias("base_snapshot_sha256"),
        start.alias("delta_window_start_utc"), F.when(start.isNotNull(), F.col("as_of")).alias("delta_window_end_utc"), F.when(F.col("_first"), F.lit(genesis_at)).alias("observed_at_utc"),
    )


def catalog_lines(states: DataFrame, id_col: str = "object_id", record_col: str = "rec") -> DataFrame:
    """(value): the canonical records in id order, one a line, for text export of a catalog of any size."""
    return states.select(lenient_int(id_col).alias("n"), F.col(id_col).cast("string").alias("t"), canonical_text(record_col).alias("value")).orderBy("n", "t").select("value")
