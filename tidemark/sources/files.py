"""Hashes of large files, read by ranges: no file, and no more than a chunk of one, is ever a value."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merkle import CHUNK, LEAST, cuts
from .days import file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that one task reads of a file at a stretch, and of a read.
RUN_BYTES, READ_BYTES = 64 << 20, 4 << 20
#: Files of a task if they are small.
FEW_FILES = 50


def file_list(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of the files below a folder, their content unread; empty ones are left out by the source."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("bytes"))


def _tasks(files: DataFrame, run_bytes: int) -> int:
    """So many that a task has a run's bytes, or FEW_FILES small files: a task costs more than a small file does."""
    told = files.agg(F.sum(F.expr(f"bytes div {run_bytes}")), F.sum(F.expr(f"bytes % {run_bytes}")), F.count("*")).first()
    return max(1, min(int((told[0] or 0) + max((told[1] or 0) // run_bytes, told[2] // FEW_FILES)) + 1, 10_000))


def chunk_hashes(files: DataFrame, size: int = CHUNK, least: int = LEAST, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(path, pos, start, end, data_hash) of the chunks (see merkle.cuts) of files (path, bytes), which a task reads by runs: it seeks to the first chunk and reads one after the other.

    A file that is shorter than its bytes say is an error.
    """
    rows = cuts(files.select("path", F.col("bytes").cast("long").alias("_n")), "_n", size, least)
    runs = rows.groupBy("path", F.expr(f"start div {run_bytes}").alias("run")).agg(F.array_sort(F.collect_list(F.struct("pos", "start", "end"))).alias("cuts"))
    n = _tasks(files, run_bytes)

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for path, todo in zip(*[batch.column(k).to_pylist() for k in (0, 1)]):
                fs, where = file_system(path)
                out = []
                with fs.open_input_file(where) as f:
                    for c in todo:
                        f.seek(c["start"])
                        data = f.read(c["end"] - c["start"])
                        if len(data) != c["end"] - c["start"]:
                            raise ValueError(f"{path} ends before byte {c['end']}")
                        out.append((path, c["pos"], c["start"], c["end"], hashlib.sha256(data).hexdigest()))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=["path", "pos", "start", "end", "data_hash"])

    return runs.repartition(n, "path", "run").select("path", "cuts").mapInArrow(run, "path string, pos long, start long, end long, data_hash string")


def file_hashes(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of whole files (path, bytes), each streamed through one hasher."""
    n = _tasks(files, RUN_BYTES)

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                fs, where = file_system(path)
                hasher = hashlib.sha256()
                with fs.open_input_stream(where, compression=None) as f:
                    while data := f.read(READ_BYTES):
                        hasher.update(data)
                found.append(hasher.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["path", "bytes", "sha256"])

    return files.select("path", F.col("bytes").cast("long").alias("bytes")).repartition(n, "path").mapInArrow(run, "path string, bytes long, sha256 string")
