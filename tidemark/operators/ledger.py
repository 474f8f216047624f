"""The ledger: one entry a day, projected from manifests, chained by base hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What an entry takes from a manifest, the second group only where it is set.
REQUIRED = ("date", "sha256", "object_count", "compressed_bytes", "provenance", "query_strategy", "archived_at")
OPTIONAL = ("state_as_of_utc", "base_snapshot_date", "base_snapshot_sha256", "delta_window_start_utc", "delta_window_end_utc")
ROLLING, GENESIS = "rolling_gp_history_delta", "genesis_from_gp"


def entries(manifests: DataFrame) -> DataFrame:
    """Ledger entries of manifests; an optional field that a manifest doesn't have is null."""
    return manifests.select(*[F.col(c) if c in manifests.columns else F.lit(None).cast("string").alias(c) for c in (*REQUIRED, *OPTIONAL)])


def upsert(ledger: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """The ledger with new entries by date, in date order.

    An entry that replaces one with another hash remembers it in previous_sha256 and the time in regenerated_at; one
    with the same hash has neither, even if the old one had.
    """
    columns = list(new.columns)
    old = ledger.select("date", *[F.col(c).alias(f"_o_{c}") for c in ledger.columns if c != "date"])
    both = old.join(new.withColumn("_new", F.lit(True)), "date", "full_outer")
    changed = F.col("_new").isNotNull() & F.col("_o_sha256").isNotNull() & (F.col("_o_sha256") != F.col("sha256"))
    kept = F.col("_new").isNull()

    def carry(c: str):
        return F.col(f"_o_{c}") if c in ledger.columns else F.lit(None)

    values = [F.when(kept, carry(c)).otherwise(F.col(c)).alias(c) for c in columns if c != "date"]
    previous = F.when(kept, carry("previous_sha256")).when(changed, F.col("_o_sha256")).alias("previous_sha256")
    at = F.when(kept, carry("regenerated_at")).when(changed, F.lit(now)).alias("regenerated_at")
    return both.select("date", *values, previous, at).orderBy("date")


def broken_links(manifests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, date, rule, detail) of rolling manifests whose base isn't archived or has another hash; keys tell archives apart and aren't null."""
    base = manifests.select(*keys, F.col("date").alias("base_snapshot_date"), F.col("date").alias("_base"), F.col("sha256").alias("_sha"))
    rolling = manifests.where(F.col("provenance") == ROLLING).join(base, [*keys, "base_snapshot_date"], "left")
    gone, other = F.col("_base").isNull(), ~F.col("_sha").eqNullSafe(F.col("base_snapshot_sha256"))
    return rolling.where(gone | other).select(*keys, "date", F.when(gone, "L09").otherwise("L10").alias("rule"), F.when(gone, F.concat(F.lit("base not archived: "), F.coalesce("base_snapshot_date", F.lit("none")))).otherwise(F.lit("base hash differs")).alias("detail"))


def field_differences(ledger: DataFrame, manifests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, date, field, ledger_value, manifest_value) where an entry differs from its manifest in a field that the manifest sets.

    Fields that only the ledger has are allowed. Dates on one side are reported by date_differences.
    """
    fields = [c for c in (*REQUIRED, *OPTIONAL) if c in manifests.columns and c != "date"]
    pair = lambda df, side: df.select(*keys, "date", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(side)) for c in fields])).alias("p")).select(*keys, "date", "p.*")
    both = pair(ledger, "ledger_value").join(pair(manifests, "manifest_value"), [*keys, "date", "field"])
    needed = F.col("field").isin(*REQUIRED) | F.col("manifest_value").isNotNull()
    return both.where(needed & ~F.col("ledger_value").eqNullSafe(F.col("manifest_value")))


def date_differences(ledger: DataFrame, manifests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, date, only_in) for days that only one of the two has."""
    on = [*keys, "date"]
    a = ledger.select(*on).distinct().join(manifests.select(*on), on, "left_anti").withColumn("only_in", F.lit("ledger"))
    b = manifests.select(*on).distinct().join(ledger.select(*on), on, "left_anti").withColumn("only_in", F.lit("manifests"))
    return a.unionByName(b)


def chain_hash(states: DataFrame, by: str = "snapshot_date", sha: str = "sha256") -> DataFrame:
    """Daily hashes with the hash of the day before, from which manifests take their base."""
    return states.withColumn("base_sha256", F.expr(f"lag({sha}) over (order by {by})"))
