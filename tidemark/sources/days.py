"""Days of an archive as plain files that become visible all at once.

write_days() writes every artifact of some days as one file, of any size, and then one commit record that names them. Readers take
the files of each day's latest commit only, so a run that ends anywhere before its record leaves the earlier days whole, and an artifact
of an earlier run never stays beside those of a later one. vacuum() deletes what no day shows any more.

root/_commits/<time>-<run>.json has a JSON object for each file; root/_files/<run>/<attempt>/<date>/<name> are the files.
"""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .shared import small_batches

# Readers and writers travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fields of a commit record.
FILE = "date string, name string, path string, bytes long, raw_bytes long, sha256 string"
_INPUT = "date string, name string, part int, seq int, text string"


def file_system(path: str):
    """The file system of a path or URI, as pyarrow has it (local, HDFS, S3 and others), and the path in it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if path.startswith("file:"):
        return LocalFileSystem(), "/" + path[5:].lstrip("/")
    return FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)


class Message(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class DayWriter(DataSourceArrowWriter):
    """Writes files from rows that come in order of (date, name, part, seq)."""

    def __init__(self, root: str, lists: tuple[str, ...], run: str, stage: bool = False, staged: tuple[str, ...] = ()):
        self.root, self.lists, self.run, self.stage, self.staged = root, lists, run, stage, staged

    def write(self, iterator):
        attempt, files, now = uuid.uuid4().hex, [], None
        for batch in iterator:
            rows = zip(*[batch.column(k).to_pylist() for k in (0, 1, 4)])
            for date, name, text in rows:
                if now is None or now.key != (date, name):
                    if now is not None:
                        files.append(now.close())
                    now = _File(self.root, f"_files/{self.run}/{attempt}", date, name, name in self.lists)
                now.add(text or "")
        if now is not None:
            files.append(now.close())
        return Message(files)

    def commit(self, messages):
        import json
        import time

        fs, root = file_system(self.root)
        lines = "".join(json.dumps(f) + "\n" for m in messages if m for f in m.files)
        for run in self.staged:
            with fs.open_input_stream(f"{root}/_staged/{run}.json") as found:
                lines += found.read().decode()
        folder, name = ("_staged", f"{self.run}.json") if self.stage else ("_commits", f"{time.time_ns():020}-{self.run}.json")
        fs.create_dir(f"{root}/{folder}", recursive=True)
        with fs.open_output_stream(f"{root}/{folder}/.{name}") as out:
            out.write(lines.encode())
        fs.move(f"{root}/{folder}/.{name}", f"{root}/{folder}/{name}")

    def abort(self, messages):
        fs, root = file_system(self.root)
        import pyarrow.fs as pafs

        if fs.get_file_info(f"{root}/_files/{self.run}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_files/{self.run}")


class _File:
    """A file as it is written: its text in order, compressed if its name says so; a list's pieces are joined by commas in brackets."""

    def __init__(self, root: str, folder: str, date: str, name: str, as_list: bool):
        import gzip
        import hashlib

        fs, base = file_system(root)
        self.key, self.path, self.as_list, self.n = (date, name), f"{folder}/{date}/{name}", as_list, 0
        fs.create_dir(f"{base}/{folder}/{date}", recursive=True)
        self.fs, self.full = fs, f"{base}/{self.path}"
        self.out = fs.open_output_stream(self.full, compression=None)
        self.zip = gzip.GzipFile("", fileobj=self.out, mode="wb", mtime=0) if name.endswith(".gz") else None
        self.hasher, self.raw = hashlib.sha256(), 0
        if as_list:
            self._put(b"[")

    def _put(self, data: bytes) -> None:
        self.hasher.update(data)
        self.raw += len(data)
        (self.zip or self.out).write(data)

    def add(self, text: str) -> None:
        self._put((b"," if self.n and self.as_list else b"") + text.encode())
        self.n += 1

    def close(self) -> dict:
        if self.as_list:
            self._put(b"]")
        if self.zip:
            self.zip.close()
        self.out.close()
        return {"date": self.key[0], "name": self.key[1], "path": self.path, "bytes": self.fs.get_file_info(self.full).size, "raw_bytes": self.raw, "sha256": self.hasher.hexdigest()}


class Days(DataSource):
    """Sink of rows (date, name, part, seq, text). Options: path, run, lists and staged (names with commas between), stage."""

    @classmethod
    def name(cls):
        return "tidemark_days"

    def schema(self):
        return _INPUT

    def writer(self, schema, overwrite):
        lists, staged = (tuple(filter(None, self.options.get(k, "").split(","))) for k in ("lists", "staged"))
        return DayWriter(self.options["path"], lists, self.options["run"], self.options.get("stage") == "true", staged)


def stage_days(texts: DataFrame, root: str, lists: tuple[str, ...] = ()) -> str:
    """Write artifacts as write_days() does, but leave them out of sight: the run that is returned goes to staged() and into the write_days() that shows them."""
    return _write(texts, root, lists, True, ())


def staged(spark: SparkSession, root: str, run: str) -> DataFrame:
    """(date, name, path, bytes, raw_bytes, sha256) of files that wait to be shown."""
    return spark.read.schema(FILE).json(f"{root}/_staged/{run}.json")


def write_days(texts: DataFrame, root: str, lists: tuple[str, ...] = (), staged: tuple[str, ...] = ()) -> None:
    """Write artifacts from rows (date, name, text) or (date, name, part, seq, text), and make their days visible at once, those of staged runs with them.

    A file has its rows' texts one after the other in order of part and seq; one named in `lists` is a JSON list of them. Names that end in .gz are
    compressed. A day that is written is replaced whole. A null text is empty, a null date or name an error.
    """
    _write(texts, root, lists, False, staged)


def _write(texts: DataFrame, root: str, lists: tuple[str, ...], stage: bool, staged: tuple[str, ...]) -> str:
    spark = texts.sparkSession
    spark.dataSource.register(Days)
    zero, run = F.lit(0), uuid.uuid4().hex
    rows = texts.select(
        F.coalesce(F.col("date").cast("string"), F.raise_error(F.lit("a day has no date")).cast("string")).alias("date"), F.coalesce(F.col("name"), F.raise_error(F.lit("an artifact has no name")).cast("string")).alias("name"),
        *[(F.col(c) if c in texts.columns else zero).cast("int").alias(c) for c in ("part", "seq")], "text",
    )
    rows = rows.repartition("date", "name").sortWithinPartitions("date", "name", "part", "seq")
    with small_batches(spark):
        rows.write.format("tidemark_days").options(path=root, run=run, lists=",".join(lists), staged=",".join(staged), stage=str(stage).lower()).mode("append").save()
    return run


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(commit, file fields) of all commit records."""
    import pyarrow.fs as pafs

    fs, base = file_system(root)
    if fs.get_file_info(f"{base}/_commits").type == pafs.FileType.NotFound:
        return spark.createDataFrame([], "commit string, " + FILE)
    found = spark.read.schema(FILE).option("pathGlobFilter", "[0-9]*.json").json(f"{root}/_commits")
    return found.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("commit"), *found.columns)


def visible(spark: SparkSession, root: str) -> DataFrame:
    """(date, name, path, bytes, raw_bytes, sha256): the files of each day's latest commit; path is a full one."""
    every = commits(spark, root)
    latest = every.groupBy("date").agg(F.max("commit").alias("commit"))
    found = every.join(latest, ["date", "commit"], "left_semi")
    return found.select("date", "name", F.concat(F.lit(root + "/"), "path").alias("path"), "bytes", "raw_bytes", "sha256")


def vacuum(spark: SparkSession, root: str, hours: float = 24) -> int:
    """Delete files that no day shows any more, of commits or unfinished runs that are older than so many hours. Returns how many there were.

    A run is young as long as any of its files is; a reader that began before a later commit keeps its files for that long.
    """
    import pyarrow.fs as pafs

    fs, base = file_system(root)
    if fs.get_file_info(f"{base}/_files").type == pafs.FileType.NotFound:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/_files")
    key = F.regexp_extract("path", r"/(_files/.+)$", 1)
    old = files.select("path", key.alias("key"), F.regexp_extract(key, r"^_files/([^/]+)/", 1).alias("run"), "modificationTime")
    young = old.groupBy("run").agg(F.max("modificationTime").alias("t")).where(F.col("t") > F.expr(f"current_timestamp() - make_dt_interval(0, 0, 0, {float(hours) * 3600})")).select("run")
    shown = visible(spark, root).select(F.regexp_extract("path", r"/(_files/.+)$", 1).alias("key"))
    gone = old.join(young, "run", "left_anti").join(shown, "key", "left_anti").select("path")

    def delete(batches):
        import pyarrow as pa

        for batch in batches:
            for path in batch.column(0).to_pylist():
                there, where = file_system(path)
                try:
                    there.delete_file(where)
                except FileNotFoundError:  # a retried task
                    pass
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return gone.mapInArrow(delete, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
