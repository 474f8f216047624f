"""The running state of every object in a state store: each batch touches the objects it has rows of, and timers let go of those that fell silent."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..feed import Feed
from ..operators.merge import IGNORED, NEW, UNCHANGED, UPDATED

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What becomes of an object that has had no row for the time to live.
EXPIRED = "expired"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Running(StatefulProcessor):
    """Keeps an object's best row and how many it has had; tells once a batch what the batch did to it. Rows are plain ones: a pandas frame for each object would cost more than its rows."""

    def __init__(self, kind: T.StructType, keys: list[str], ttl_ms: int | None):
        self.kind, self.ttl = kind, ttl_ms
        self.keys, self.content = [kind.names.index(k) for k in keys], kind.names.index("tidemark_content")
        self.told = Row("tidemark_id", *[n for n in kind.names if n != "tidemark_content"], "rows_seen", "change")
        # nulls lowest, NaN highest
        self.rank = lambda r: tuple((r[k] is not None, r[k] != r[k], 0 if r[k] != r[k] else r[k]) for k in self.keys)

    def init(self, handle):
        self.handle = handle
        self.best = handle.getValueState("best", T.StructType([*self.kind.fields, T.StructField("tidemark_rows", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        width, n, newest, row, high = len(self.kind), 0, 0, None, None
        for r in rows:
            # id, what is kept, milliseconds, time; by place, as a search by name for each value of each row costs more than the rest
            n, newest, now = n + 1, max(newest, r[width + 1] or 0), r[1 : width + 1]
            # the largest key, ties by the hash of the content, as in a batch
            rank = (self.rank(now), now[self.content])
            if row is None or rank > high:
                row, high = now, rank
        held = self.best.get()
        if held is None:
            change, now, seen = NEW, row, 0
        else:
            *before, seen = held
            if high[0] > self.rank(before):
                change, now = UPDATED, row
            else:
                change, now = (UNCHANGED if row[self.content] == before[self.content] else IGNORED), tuple(before)
        self.best.update((*now, seen + n))
        if self.ttl is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(max(newest, timerValues.getCurrentWatermarkInMs()) + self.ttl)
        yield self._told(key, now, seen + n, change)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.best.get()
        if held is not None:
            self.best.clear()
            yield self._told(key, held[:-1], held[-1], EXPIRED)

    def _told(self, key, row, seen, change):
        return self.told(key[0], *[v for k, v in enumerate(row) if k != self.content], seen, change)

    def close(self):
        pass


def running_state(stream: DataFrame, feed: Feed, delay: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """(id, row, rows_seen, change): of each object that a batch has rows of, its state after the batch, how many rows it has had, and what the batch did to it.

    change is new, updated, unchanged or ignored_older, as in merge. With ttl_ms an object without rows for that long, by event time, is expired and forgotten; a later row is new, and rows behind the watermark are dropped.
    Rows without an id are left out; without a ttl no row is too late. The session's state store must be STORE, as run_state() sees to. State is read and written by object, so a batch costs what it touches.
    """
    rows = stream.where(F.col(feed.id).isNotNull())
    content = feed.content_hash(stream)
    rows = rows.withColumn("tidemark_content", content).withColumn("tidemark_at", F.col(feed.created).cast("timestamp"))
    if ttl_ms is not None:
        rows = rows.withWatermark("tidemark_at", delay)
    kinds = {f.name: f for f in rows.schema}
    # NTZ times are no state type of Python rows; they go as they are shown
    kept = [c for c in stream.columns if c != feed.id]
    ntz = [c for c in kept if isinstance(kinds[c].dataType, T.TimestampNTZType)]
    at = [F.unix_millis("tidemark_at").alias("tidemark_ms"), "tidemark_at"]
    rows = rows.select(feed.id, *[F.col(c).cast("string").alias(c) if c in ntz else F.col(c) for c in kept], "tidemark_content", *at)
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name not in (feed.id, "tidemark_ms", "tidemark_at")])
    out = T.StructType([T.StructField("tidemark_id", rows.schema[feed.id].dataType), *[f for f in kind if f.name != "tidemark_content"], T.StructField("rows_seen", T.LongType()), T.StructField("change", T.StringType())])
    mode = "EventTime" if ttl_ms is not None else "None"
    found = rows.groupBy(feed.id).transformWithState(Running(kind, [feed.created, *feed.ties], ttl_ms), out, "Update", mode)
    return found.select(F.col("tidemark_id").alias(feed.id), *[F.col(c).cast("timestamp_ntz").alias(c) if c in ntz else F.col(c) for c in kept], "rows_seen", "change")


def run_state(stream: DataFrame, feed: Feed, path: str, checkpoint: str, delay: str = "0 seconds", ttl_ms: int | None = None):
    """Write what each batch changed to path/<batch>, over what an unfinished run of the same batch left; returns the query, which ends when the available input is read."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    found = running_state(stream, feed, delay, ttl_ms)
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, STORE)
    try:  # a query takes the settings of its start
        return found.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(name, before)
