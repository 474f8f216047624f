"""Plans for an archive's upkeep: what to write, keep, restore and publish. Each returns a table of decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rules import payload_problem

#: Upload policies and backends.
IF_MISSING, ALWAYS, NEVER = "if_missing", "always_mirror", "never"
NO_BACKEND, RELEASE, STORE = "none", "github_release", "arweave"


def to_write(planned: DataFrame, manifests: DataFrame, force: bool = False) -> DataFrame:
    """Planned dates that aren't archived yet; all of them with force."""
    return planned if force else planned.join(manifests.select("date"), "date", "left_anti")


def retention(dates: DataFrame, keep: int, bundled: DataFrame | None = None) -> DataFrame:
    """(date, action): the newest `keep` dates are retained, others pruned; with `bundled` an unbundled date is skipped instead.

    keep of 0 or less retains none.
    """
    ranked = dates.select("date").distinct().withColumn("_r", F.expr("row_number() over (order by date desc)"))  # one row for each day
    action = F.when(F.col("_r") <= keep, "retained")
    if bundled is None:
        return ranked.select("date", action.otherwise("pruned").alias("action"))
    marked = ranked.join(bundled.select("date").distinct().withColumn("_b", F.lit(True)), "date", "left")
    return marked.select("date", action.when(F.col("_b").isNull(), "skipped").otherwise("pruned").alias("action"))


def status_counts(plan: DataFrame, column: str = "action") -> DataFrame:
    return plan.groupBy(column).agg(F.count("*").alias("n"))


def restore(manifests: DataFrame, present: DataFrame, latest: int | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """(date, action): the latest n dates, or those from start to end, are restored unless their catalog is present."""
    dates = manifests.select("date").distinct()
    if latest is not None:
        if latest < 0:
            raise ValueError("latest must not be negative")
        dates = dates.orderBy(F.desc("date")).limit(latest)
    else:
        dates = dates.where(F.col("date").between(start, end))
    marked = dates.join(present.select("date").distinct().withColumn("_p", F.lit(True)), "date", "left")
    return marked.select("date", F.when(F.col("_p"), "present").otherwise("restore").alias("action"))


def restore_checked(plan: DataFrame, payloads: DataFrame) -> DataFrame:
    """(date, status) of a restore() plan whose payloads have come: skipped, hydrated, or what is wrong with a payload, which then isn't accepted.

    payloads: rows as the audit rules take them (sources.archive.days_of); a date without one, or with a catalog or manifest that can't be read, is unreadable.
    """
    fine = F.col("manifest").isNotNull() & F.coalesce(F.col("catalog.readable"), F.lit(False))
    checked = payloads.select("date", F.when(fine, F.coalesce(payload_problem(), F.lit("hydrated"))).otherwise("unreadable").alias("_found"))
    both = plan.join(checked, "date", "left")
    return both.select("date", F.when(F.col("action") == "present", "skipped").otherwise(F.coalesce("_found", F.lit("unreadable"))).alias("status"))


def publish_ledgered(bundles: DataFrame, receipts: DataFrame, destination: str, force: bool = False, policy: str = IF_MISSING) -> DataFrame:
    """(date, status): skipped if the destination's receipt has the bundle's hash, unless forced or the policy always mirrors."""
    own = receipts.where(F.col("destination") == destination).select("date", F.col("bundle_sha256").alias("_sha"))
    same = F.coalesce(F.col("_sha") == F.col("bundle_sha256"), F.lit(False))
    if policy == NEVER:
        return bundles.select("date", F.lit("upload_disabled").alias("status"))
    skip = same & F.lit(not force and policy != ALWAYS)
    return bundles.join(own, "date", "left").select("date", F.when(skip, "skipped").otherwise("uploaded").alias("status"))


def publish_released(bundles: DataFrame, releases: DataFrame, force: bool = False, prerelease: bool = False) -> DataFrame:
    """(date, status) for a release host: created without a release; with an existing asset skipped, or its metadata updated, or uploaded."""
    found = releases.select("date", F.col("has_asset").alias("_a"), F.lit(True).alias("_r"))
    status = F.when(F.col("_r").isNull(), "created").when(~F.coalesce("_a", F.lit(False)), "uploaded")
    existing = "uploaded" if force else "metadata_updated" if prerelease else "skipped"
    return bundles.join(found, "date", "left").select("date", status.otherwise(existing).alias("status"))


def publication(bundles: DataFrame, receipts: DataFrame, releases: DataFrame, backend: str, policy: str = IF_MISSING, force: bool = False, prerelease: bool = False) -> DataFrame:
    """(date, destination, status, reason) of what publishing would do.

    Without a backend, or with the policy never, nothing is uploaded. The release host, which doesn't heed the policy otherwise, is followed by the ledgered store; the store may also stand alone.
    """
    if policy not in (IF_MISSING, ALWAYS, NEVER):
        raise ValueError(f"unknown policy {policy}")
    none = F.lit(None).cast("string")
    if backend == NO_BACKEND or policy == NEVER:
        return bundles.select("date", none.alias("destination"), F.lit("skipped").alias("status"), F.lit("upload_disabled").alias("reason"))
    if backend not in (RELEASE, STORE):
        raise ValueError(f"unknown backend {backend}")
    stored = publish_ledgered(bundles, receipts, STORE, force, policy).select("date", F.lit(STORE).alias("destination"), "status", none.alias("reason"))
    if backend == STORE:
        return stored
    return publish_released(bundles, releases, force, prerelease).select("date", F.lit(RELEASE).alias("destination"), "status", none.alias("reason")).unionByName(stored)


def merge_receipts(receipts: DataFrame, new: DataFrame) -> DataFrame:
    """One receipt for each date and destination, the last by updated_at; a new one wins over an old one of the same time."""
    both = receipts.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    ranked = both.withColumn("_r", F.expr("row_number() over (partition by date, destination order by updated_at desc, _new desc)"))
    return ranked.where("_r = 1").drop("_r", "_new")


def nested_receipts(receipts: DataFrame, bundle: tuple[str, ...] = ("bundle_sha256",)) -> DataFrame:
    """(date, destinations): a day's receipts as a map by destination."""
    payload = [c for c in receipts.columns if c not in ("date", "destination")]
    pairs = F.array_sort(F.collect_list(F.struct("destination", F.struct(*payload))))
    return receipts.groupBy("date").agg(F.map_from_entries(pairs).alias("destinations"))
