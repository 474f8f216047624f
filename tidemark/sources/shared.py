"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch for Python workers.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or a folder of its own in local mode."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if given is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession):
    """Python workers get texts in Arrow batches of at most BATCH_BYTES while a table is written; the session's own setting comes back afterwards.

    A batch is in memory on both sides, so large ones cost several times their size in each task.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path, schema = new_path(df.sparkSession, name), df.schema
    with small_batches(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that stored() has written and nothing reads any more."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
