"""Audit rules of an archive, as (date, rule, detail) violations.

A day is one row that has the parsed artifacts as structs, null where an artifact is missing, and a flag where it
couldn't be read (see sources.archive.days). Every rule is a condition on such a row, so all days are checked in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.canonical import canonical_text, sha256
from ..functions.scalars import lenient_int
from ..schema import ENTRY
from .ledger import GENESIS, ROLLING, broken_links, date_differences, field_differences

#: Fields that every record has; null values pass.
REQUIRED_FIELDS = ("NORAD_CAT_ID", "CREATION_DATE", "EPOCH", "MEAN_MOTION", "ECCENTRICITY", "INCLINATION", "RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY")
MIN_OBJECTS = 40_000


def invalid_records(records: DataFrame, id_col: str = "object_id", record_col: str = "rec", required=REQUIRED_FIELDS) -> DataFrame:
    """(id, missing_fields) of records without a required key."""
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.map_keys(record_col)))
    return records.select(id_col, missing.alias("missing_fields")).where(F.size("missing_fields") > 0)


def require_valid(records: DataFrame, least: int, id_col: str = "object_id", record_col: str = "rec", required=REQUIRED_FIELDS) -> None:
    """Raises on fewer than `least` records or on the first invalid one by id."""
    n = records.count()
    if n < least:
        raise ValueError(f"{n} records, below the minimum of {least}: likely an incomplete snapshot")
    bad = invalid_records(records, id_col, record_col, required).orderBy(lenient_int(id_col), id_col).first()
    if bad:
        raise ValueError(f"record {bad[0]} misses fields: {', '.join(bad[1])}")


def catalog_facts(text: str = "catalog_text", required=REQUIRED_FIELDS, id_field: str = "NORAD_CAT_ID") -> list[Column]:
    """What the rules need to know of a catalog's text: hash, bytes, canonical form, count, ids and missing keys."""
    records = F.from_json(F.col(text), "array<map<string,string>>")
    ids = F.transform(records, lambda r: r[id_field])
    numbers = F.transform(ids, lambda i: lenient_int(i))
    canonical = F.concat(F.lit("["), F.array_join(F.transform(records, canonical_text), ","), F.lit("]"))
    return [
        records.isNotNull().alias("readable"), sha256(text).alias("sha256"), F.octet_length(text).cast("long").alias("raw_bytes"), (canonical == F.col(text)).alias("canonical"),
        F.size(records).cast("long").alias("objects"), (F.size(F.array_distinct(ids)) < F.size(ids)).alias("repeats"), (F.array_sort(numbers) == numbers).alias("ordered"),
        F.exists(records, lambda r: F.size(F.array_except(F.array(*map(F.lit, required)), F.map_keys(r))) > 0).alias("incomplete"),
    ]


def _off(left: str, right: Column) -> Column:
    return ~F.col(left).eqNullSafe(right)


def _counted(artifact: str, count: str, items: str) -> Column:
    return F.col(f"{artifact}.{items}").isNull() | _off(f"{artifact}.{count}", F.size(f"{artifact}.{items}").cast("long"))


def day_rules(least: int = MIN_OBJECTS, require_audit: bool = False, require_catalog: bool = False, latest_catalogs: int = 0) -> list[tuple[str, Column]]:
    """(rule, condition that breaks it). Rules on an artifact hold only if it is there and was read."""
    c = F.col
    manifest = c("manifest").isNotNull() & ~c("manifest_broken")
    catalog = manifest & c("catalog").isNotNull()
    fine = catalog & c("catalog.readable")
    go = manifest & (c("catalog").isNull() | c("catalog.readable"))  # an unreadable catalog ends the day's checks
    rolling, genesis = c("manifest.provenance").eqNullSafe(F.lit(ROLLING)), c("manifest.provenance").eqNullSafe(F.lit(GENESIS))
    delta = go & rolling & c("delta").isNotNull() & ~c("delta_broken")
    audit = go & c("audit").isNotNull() & ~c("audit_broken")
    seen = audit & c("visibility").isNotNull() & ~c("visibility_broken")
    needed = F.lit(require_catalog) | (c("_recent") <= latest_catalogs)
    kinds = ("new_object_count", "updated_object_count", "unchanged_update_count", "ignored_older_update_count")
    total = sum((F.coalesce(c(f"delta.{k}"), F.lit(0)) for k in kinds), F.lit(0)).cast("long")
    return [
        ("R01", c("manifest").isNull() & ~c("manifest_broken")),
        ("R02", c("manifest_broken")),
        ("R03", manifest & _off("manifest.date", c("date"))),
        ("R04", catalog & ~c("catalog.readable")),
        ("R05", fine & _off("manifest.sha256", c("catalog.sha256"))),
        ("R06", fine & ~c("catalog.canonical")),
        ("R07", fine & _off("manifest.raw_bytes", c("catalog.raw_bytes"))),
        ("R08", fine & _off("manifest.compressed_bytes", c("compressed_bytes"))),
        ("R09", fine & _off("manifest.object_count", c("catalog.objects"))),
        ("R10", fine & ((c("catalog.objects") < least) | c("catalog.incomplete"))),
        ("R11", fine & c("catalog.repeats")),
        ("R12", fine & ~c("catalog.ordered")),
        ("R13", manifest & c("catalog").isNull() & needed),
        ("R14", manifest & c("catalog").isNull() & ~needed & (F.coalesce(c("manifest.object_count"), F.lit(0)) < least)),
        ("R15", go & rolling & c("delta").isNull() & ~c("delta_broken")),
        ("R16", go & rolling & c("delta_broken")),
        ("R17", delta & _off("delta.date", c("date"))),
        ("R18", delta & _off("delta.window_start_utc", c("manifest.delta_window_start_utc"))),
        ("R19", delta & _off("delta.window_end_utc", c("manifest.delta_window_end_utc"))),
        ("R20", delta & _counted("delta", "new_object_count", "new_norad_cat_ids")),
        ("R21", delta & _counted("delta", "updated_object_count", "updated_norad_cat_ids")),
        ("R22", delta & _counted("delta", "unchanged_update_count", "unchanged_update_norad_cat_ids")),
        ("R23", delta & _counted("delta", "ignored_older_update_count", "ignored_older_update_norad_cat_ids")),
        ("R24", delta & _off("delta.deduped_update_count", total)),
        ("R25", go & genesis & (c("delta").isNotNull() | c("delta_broken"))),
        ("R26", go & ~rolling & ~genesis),
        ("R27", go & F.lit(require_audit) & c("audit").isNull() & ~c("audit_broken")),
        ("R28", go & F.lit(require_audit) & c("visibility").isNull() & ~c("visibility_broken")),
        ("R29", go & c("audit_broken")),
        ("R30", audit & _off("audit.date", c("date"))),
        ("R31", audit & _off("audit.archive_object_count", c("manifest.object_count"))),
        ("R32", audit & _counted("audit", "missing_from_current_gp_count", "missing_from_current_gp")),
        ("R33", audit & _counted("audit", "present_in_current_gp_not_in_archive_count", "present_in_current_gp_not_in_archive")),
        ("R34", audit & _counted("audit", "reappeared_in_current_gp_count", "reappeared_in_current_gp")),
        ("R35", audit & c("visibility_broken")),
        ("R36", seen & _off("visibility.date", c("date"))),
        ("R37", seen & _off("visibility.observed_at_utc", c("audit.observed_at_utc"))),
        ("R38", seen & c("visibility.missing_objects").isNull()),
        ("R39", seen & c("visibility.missing_objects").isNotNull() & _off("audit.missing_from_current_gp_count", F.size("visibility.missing_objects").cast("long"))),
    ]


def day_violations(days: DataFrame, **options) -> DataFrame:
    """(date, rule, detail) of every broken day rule."""
    # dates alone are put in order, their days' artifacts stay where they are
    dates = days.select("date").distinct().withColumn("_recent", F.expr("row_number() over (order by date desc)"))
    ranked = days.join(dates, "date")
    broken = F.filter(F.array(*[F.when(condition, F.lit(rule)) for rule, condition in day_rules(**options)]), lambda r: r.isNotNull())
    return ranked.select("date", F.explode(broken).alias("rule")).withColumn("detail", F.concat(F.lit("snapshot "), F.col("date")))


def ledger_violations(ledger: DataFrame | None, manifests: DataFrame, readable: bool = True, is_list: bool = True) -> DataFrame:
    """(date, rule, detail) of broken ledger rules. ledger: entries with `position` in the file; null dates mark entries that are no objects."""
    spark = manifests.sparkSession
    if ledger is None or not readable or not is_list:
        rule = "L01" if ledger is None and readable and is_list else "L02" if not readable else "L03"
        return spark.createDataFrame([(None, rule, "ledger")], "date string, rule string, detail string")
    return _ledger_rules(ledger, manifests)


def ledger_text_violations(texts: DataFrame, manifests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """ledger_violations() of ledgers' texts (keys, text), one for each archive, in one pass: no text breaks L01, text that is no JSON L02, another value than a list L03.

    keys are columns of texts and manifests that tell archives apart and aren't null; without them all is one archive.
    """
    value = F.try_parse_json("text")
    listed = F.try_variant_get(value, "$", "array<variant>")
    state = texts.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(value.isNotNull()).alias("read"), F.count_if(listed.isNotNull()).alias("lists"))
    if keys:
        state = manifests.select(*keys).distinct().join(state, list(keys), "full_outer").na.fill(0, ["n", "read", "lists"])
    first = F.when(F.col("n") == 0, "L01").when(F.col("read") == 0, "L02").when(F.col("lists") == 0, "L03")
    unfit = state.select(*keys, F.lit(None).cast("string").alias("date"), first.alias("rule"), F.lit("ledger").alias("detail")).where("rule is not null")
    fine = texts.where(listed.isNotNull()).withColumn("_list", F.lit(True))
    rows = fine.select(*keys, F.posexplode(F.from_json("text", "array<string>")).alias("position", "e"))
    entries = rows.select(*keys, "position", F.from_json("e", ENTRY).alias("e")).select(*keys, "position", "e.*")
    # without a list there is nothing to hold manifests against
    known = manifests.withColumn("_list", F.lit(True)).join(fine, [*keys, "_list"], "left_semi").drop("_list")
    return unfit.unionByName(_ledger_rules(entries, known, keys))


def _ledger_rules(ledger: DataFrame, manifests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    entries = ledger.where("date is not null")
    told = lambda df, rule, detail: df.select(*keys, "date", F.lit(rule).alias("rule"), detail.alias("detail"))
    repeated = told(entries.groupBy(*keys, "date").count().where("count > 1"), "L04", F.lit("repeated date"))
    before = F.lag("date").over(Window.partitionBy(*keys).orderBy("position"))
    order = told(entries.withColumn("_before", before).where("_before > date"), "L05", F.lit("not in date order"))
    sets = told(date_differences(entries, manifests, keys), "L06", F.concat(F.lit("only in "), "only_in"))
    no_object = told(ledger.where("date is null"), "L07", F.concat(F.lit("entry "), F.col("position").cast("string")))
    fields = told(field_differences(entries, manifests, keys), "L08", F.col("field"))
    return reduce(DataFrame.unionByName, [repeated, order, sets, no_object, fields, broken_links(manifests, keys)])


def archive_violations(days: DataFrame, ledger: DataFrame | None, **options) -> DataFrame:
    """All violations of an archive: an archive without a day breaks A01; only manifests whose date fits their path enter the ledger's check."""
    manifests = days.where("manifest is not null and not manifest_broken and manifest.date = date").select("manifest.*")
    none = days.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("date"), F.lit("A01").alias("rule"), F.lit("no snapshots").alias("detail"))
    return day_violations(days, **options).unionByName(ledger_violations(ledger, manifests)).unionByName(none)


def require_no_violations(found: DataFrame, shown: int = 1000) -> None:
    """Raises with the violations in order, the first ones by date and rule in the message."""
    rows = found.orderBy("date", "rule", "detail").limit(shown).collect()
    if rows:
        raise ValueError("archive validation failed:\n" + "\n".join(f"  - {r['rule']} {r['date']}: {r['detail']}" for r in rows))


def verify_hashes(computed: DataFrame, manifests: DataFrame) -> DataFrame:
    """(date, stored, computed, status): VERIFIED or MISMATCH for days that both have. computed: (date, sha256)."""
    both = computed.select("date", F.col("sha256").alias("computed")).join(manifests.select("date", F.col("sha256").alias("stored")), "date")
    return both.select("date", "stored", "computed", F.when(F.col("stored").eqNullSafe(F.col("computed")), "VERIFIED").otherwise("MISMATCH").alias("status"))


def payload_problem() -> Column:
    """The first thing wrong with a day's catalog: hash, raw bytes, compressed bytes, count, canonical form; null if nothing."""
    tests = (("sha256", _off("manifest.sha256", F.col("catalog.sha256"))), ("raw_bytes", _off("manifest.raw_bytes", F.col("catalog.raw_bytes"))), ("compressed_bytes", _off("manifest.compressed_bytes", F.col("compressed_bytes"))), ("object_count", _off("manifest.object_count", F.col("catalog.objects"))), ("canonical", ~F.col("catalog.canonical")))
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in tests])


def bundle_problems(bundles: DataFrame, manifests: DataFrame) -> DataFrame:
    """(date, problem) of bundle manifests that differ from their day's manifest in hash or count, or have none."""
    day = manifests.select("date", F.col("sha256").alias("_sha"), F.col("object_count").alias("_n"), F.lit(True).alias("_is"))
    problem = F.when(F.col("_is").isNull(), "no manifest").when(_off("catalog_sha256", F.col("_sha")), "sha256").when(_off("object_count", F.col("_n")), "object_count")
    return bundles.join(day, "date", "left").select("date", problem.alias("problem")).where("problem is not null")
