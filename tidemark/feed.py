"""Which columns of a table make it a feed of revisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.canonical import canonical_text


@dataclass(frozen=True)
class Feed:
    """id names the object, created the publication time, ties what decides between rows of the same time."""

    id: str = "object_id"
    created: str = "created"
    ties: tuple[str, ...] = ()

    def key(self, prefix: str = "") -> Column:
        """The selection key: the larger one wins."""
        return F.struct(*[F.col(prefix + c) for c in (self.created, *self.ties)])

    def content(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c != self.id]

    def comparable(self, df: DataFrame, column: str, prefix: str = "") -> Column:
        """The column in a form that has an equality and a hash; maps become canonical text."""
        return canonical_text(F.col(prefix + column)) if isinstance(df.schema[column].dataType, T.MapType) else F.col(prefix + column)

    def content_hash(self, df: DataFrame, prefix: str = "") -> Column:
        """Decides between rows with equal keys, which have no first one in Spark."""
        return F.xxhash64(*[self.comparable(df, c, prefix) for c in self.content(df)])


#: Driver tables as feeds.
EVENTS = Feed("user_id", "ts", ("event_id",))
ORDERS = Feed("o_custkey", "o_orderdate", ("o_orderkey",))
