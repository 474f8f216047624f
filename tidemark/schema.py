"""Schemas of catalog rows and of the artifacts that describe a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types that the source declares for its fields; all others are texts.
TYPED = {
    "NORAD_CAT_ID": "bigint", "GP_ID": "bigint", "ELEMENT_SET_NO": "bigint", "EPHEMERIS_TYPE": "bigint", "REV_AT_EPOCH": "bigint", "FILE": "decimal(20,0)",
    "MEAN_MOTION": "decimal(13,8)", "ECCENTRICITY": "decimal(13,8)", "INCLINATION": "decimal(7,4)", "RA_OF_ASC_NODE": "decimal(7,4)", "ARG_OF_PERICENTER": "decimal(7,4)", "MEAN_ANOMALY": "decimal(7,4)",
    "BSTAR": "decimal(19,14)", "MEAN_MOTION_DOT": "decimal(9,8)", "MEAN_MOTION_DDOT": "decimal(22,13)", "SEMIMAJOR_AXIS": "double", "PERIOD": "double", "APOAPSIS": "double", "PERIAPSIS": "double",
    "CREATION_DATE": "timestamp_ntz", "EPOCH": "timestamp_ntz", "LAUNCH_DATE": "date", "DECAY_DATE": "date",
}

MANIFEST = (
    "date string, cutoff_utc string, state_as_of_utc string, sha256 string, object_count bigint, raw_bytes bigint, compressed_bytes bigint, provenance string, format string, source string, "
    "pipeline_version string, query_strategy string, api_query_base string, api_query_paths array<string>, archived_at string, base_snapshot_date string, base_snapshot_sha256 string, "
    "delta_window_start_utc string, delta_window_end_utc string, observed_at_utc string"
)
DELTA = (
    "date string, window_start_utc string, window_end_utc string, raw_row_count bigint, deduped_update_count bigint, new_object_count bigint, updated_object_count bigint, unchanged_update_count bigint, "
    "ignored_older_update_count bigint, carried_forward_count bigint, new_norad_cat_ids array<string>, updated_norad_cat_ids array<string>, unchanged_update_norad_cat_ids array<string>, ignored_older_update_norad_cat_ids array<string>"
)
MISSING = "norad_cat_id string, object_name string, last_gp_creation_date string, first_missing_in_current_gp_audit string, consecutive_missing_audits bigint"
AUDIT = (
    "date string, observed_at_utc string, archive_object_count bigint, current_gp_object_count bigint, present_ids_sha256 string, missing_from_current_gp_count bigint, present_in_current_gp_not_in_archive_count bigint, "
    f"reappeared_in_current_gp_count bigint, missing_from_current_gp array<struct<{MISSING.replace(' ', ':').replace(',:', ',')}>>, present_in_current_gp_not_in_archive array<string>, "
    "reappeared_in_current_gp array<struct<norad_cat_id:string,object_name:string,reappeared_at_utc:string,previously_missing_since:string>>"
)
STATE = "struct<norad_cat_id:string,object_name:string,last_gp_creation_date:string,last_seen_in_current_gp_audit:string,first_missing_in_current_gp_audit:string,consecutive_missing_audits:bigint>"
VISIBILITY = f"date string, observed_at_utc string, missing_objects map<string,{STATE}>"
ENTRY = (
    "date string, sha256 string, object_count bigint, compressed_bytes bigint, provenance string, query_strategy string, archived_at string, state_as_of_utc string, base_snapshot_date string, base_snapshot_sha256 string, "
    "delta_window_start_utc string, delta_window_end_utc string, previous_sha256 string, regenerated_at string"
)


def typed(records: DataFrame, record_col: str = "rec") -> DataFrame:
    """Columns of a record map by the declared types; a value that doesn't fit its type is null."""
    def value(field: str, kind: str) -> Column:
        return F.col(record_col)[field].try_cast(kind).alias(field.lower())

    texts = ("OBJECT_NAME", "OBJECT_ID", "OBJECT_TYPE", "COUNTRY_CODE", "RCS_SIZE", "SITE")
    return records.select(*[value(f, k) for f, k in TYPED.items()], *[F.col(record_col)[f].alias(f.lower()) for f in texts])
