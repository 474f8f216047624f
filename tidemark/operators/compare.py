"""Two sets of records side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import record_hash
from ..functions.scalars import lenient_int

ONLY_LEFT, ONLY_RIGHT, MATCHED, MISMATCHED = "only_left", "only_right", "matched", "mismatched"


def align(left: DataFrame, right: DataFrame, id_col: str = "object_id", record_col: str = "rec") -> DataFrame:
    """(id, left, right, status) of every object; records match if their canonical texts do."""
    a = left.select(id_col, F.col(record_col).alias("left"), F.lit(True).alias("_l"))
    b = right.select(id_col, F.col(record_col).alias("right"), F.lit(True).alias("_r"))
    status = F.when(F.col("_l").isNull(), ONLY_RIGHT).when(F.col("_r").isNull(), ONLY_LEFT).when(record_hash("left") == record_hash("right"), MATCHED).otherwise(MISMATCHED)
    return a.join(b, id_col, "full_outer").select(id_col, "left", "right", status.alias("status"))


def compare_counts(aligned: DataFrame) -> DataFrame:
    """One row of counts."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    return aligned.agg(
        F.count_if(F.col("status") != ONLY_RIGHT).alias("left_count"), F.count_if(F.col("status") != ONLY_LEFT).alias("right_count"),
        F.count_if(F.col("status").isin(MATCHED, MISMATCHED)).alias("shared_count"), is_(MATCHED).alias("matched_count"), is_(MISMATCHED).alias("mismatched_count"),
        is_(ONLY_LEFT).alias("only_left_count"), is_(ONLY_RIGHT).alias("only_right_count"),
    )


def sample(aligned: DataFrame, status: str, n: int = 25, id_col: str = "object_id") -> DataFrame:
    """The n objects of a status with the smallest ids by integer value: a report, not the whole result."""
    return aligned.where(F.col("status") == status).orderBy(lenient_int(id_col), F.col(id_col).cast("string")).limit(n)


def field_diff(aligned: DataFrame, id_col: str = "object_id", shown: int = 25) -> DataFrame:
    """(id, differing_fields, differing_field_count) of mismatched objects; the names are sorted and the first ones shown.

    A field that is missing and one that is null are equal here, though not in the records' hashes.
    """
    names = F.array_union(F.map_keys("left"), F.map_keys("right"))
    differ = F.array_sort(F.filter(names, lambda k: ~F.col("left")[k].eqNullSafe(F.col("right")[k])))
    found = aligned.where(F.col("status") == MISMATCHED).withColumn("_d", differ)
    return found.select(id_col, F.slice("_d", 1, shown).alias("differing_fields"), F.size("_d").alias("differing_field_count"))


def lookup(wanted: DataFrame, rows: DataFrame, id_col: str = "object_id") -> DataFrame:
    """The rows of the wanted ids."""
    return rows.join(wanted.select(id_col).distinct(), id_col, "left_semi")
