"""Decision tables: eligibility, coverage, repair and gap status as ordered rules over columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.hourly import SUPPORTED


def first_reason(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The name of the first rule that holds."""
    out = F.lit(otherwise)
    for condition, name in reversed(rules):
        out = F.when(condition, name).otherwise(out)
    return out


def all_reasons(rules: list[tuple[Column, str]], sep: str = ";", otherwise: str | None = "ok") -> Column:
    """The names of all rules that hold, in order."""
    joined = F.concat_ws(sep, *[F.when(condition, name) for condition, name in rules])
    return F.when(joined == "", F.lit(otherwise)).otherwise(joined)


def mapping_eligibility(rows: DataFrame, source: int, day: str) -> DataFrame:
    """Adds eligibility and warning. rows: a stored series (stored_*) beside the core's series (series_*), phenomenon
    (phenomenon_*) and property (property_*), null where a left join found none."""
    c, start = F.col, F.lit(day).cast("timestamp_ntz")
    differs = lambda a, b: ~c(a).eqNullSafe(c(b))
    eligibility = first_reason([
        (c("series_id").isNull(), "missing_timeseries"), (c("series_source") != source, "connector_mismatch"), (c("series_station").isNull(), "station_id_null"),
        (c("phenomenon_id").isNull(), "missing_phenomenon"), (c("phenomenon_source") != c("series_source"), "phenomenon_connector_mismatch"), (c("property_code").isNull(), "missing_observed_property"),
        (~F.lower("property_code").isin(*SUPPORTED), "pollutant_not_requested"), (c("first_value_at").isNull(), "first_value_at_null"),
        (c("first_value_at") > start + F.expr("INTERVAL 1 DAY"), "first_value_at_after_day_end"), (c("ended_at") < start, "ended_before_day_start"),
    ], "eligible")
    warning = all_reasons([
        (c("stored_source") != c("series_source"), "stored_connector_differs"), (differs("stored_station", "series_station"), "stored_station_differs"),
        (differs("stored_code", "property_code"), "stored_pollutant_differs"), (c("stations") != 1, "multiple_stations_for_id"), (c("measures") != 1, "multiple_pollutants_for_id"),
    ], ", ", None)
    return rows.withColumns({"eligibility": eligibility, "warning": warning})


def coverage(rows: DataFrame) -> DataFrame:
    """Adds reasons, complete and state from counts of what a read missed."""
    n = lambda x: F.col(x) > 0
    reasons = all_reasons([(n("missing_days"), "missing_day_manifest"), (n("missing_sources"), "missing_connector_manifest"), (n("missing_files"), "missing_parquet"), (F.col("limited"), "limited_by_limit"), (n("skipped_days"), "timeseries_index_skipped_day"), (n("warnings"), "timeseries_index_warning")], ";", "")
    return rows.withColumn("reasons", reasons).withColumns({"complete": F.col("reasons") == "", "state": F.when(F.col("reasons") == "", "complete").otherwise("partial")})


def gap_status(rows: DataFrame) -> DataFrame:
    """Adds status. rows: pollutant_code, obs_rows, index_rows, obs_hours and index_hours (arrays), has_obs_index,
    has_index, listed_rows (null where unknown)."""
    c = F.col
    expected = F.when(c("pollutant_code").isin(*SUPPORTED), c("obs_hours")).otherwise(F.slice("obs_hours", 1, 0))
    return rows.withColumn("status", all_reasons([
        ((F.size(expected) > 0) & (F.size("index_hours") == 0), "missing_aqi_data"), ((c("index_rows") > 0) & ~c("has_index"), "missing_aqi_index"), ((c("obs_rows") > 0) & ~c("has_obs_index"), "missing_obs_index"),
        (F.size(F.array_except(expected, "index_hours")) > 0, "missing_expected_aqi_hours"), ((c("index_rows") > 0) & (c("listed_rows") < c("index_rows")), "stale_or_partial_aqi_index"),
    ]))


def repair_kind(gap: Column, measure: Column, source_unavailable: Column, hash_verified: Column) -> Column:
    """What a finding calls for, by the kind of gap."""
    known = measure.isin(*SUPPORTED)
    return first_reason([
        ((gap == "pollutant_dir_missing") & ~known, "unclassified"), (gap.startswith("connector_manifest_"), "connector_manifest_repair"), (gap.startswith("day_manifest_"), "day_manifest_repair"),
        (gap.startswith("index_") | gap.startswith("latest_index_"), "index_repair"), (gap.startswith("observation_content_hash_") & hash_verified, "pollutant_manifest_repair"),
        (gap.isin("pollutant_dir_missing", "parquet_missing", "row_count_mismatch") & source_unavailable, "source_mapping_issue"), (gap.isin("pollutant_dir_missing", "parquet_missing", "row_count_mismatch"), "data_repair"),
    ], "unclassified")


def in_recent_window(day: Column, today: str, days: int = 7) -> Column:
    """The `days` whole days before today."""
    t = F.lit(today).cast("date")
    return day.between(F.date_sub(t, days), F.date_sub(t, 1))


def window_bounds(now: str, start: Column, end: Column, max_days: int) -> tuple[Column, Column]:
    """An explicit window, not beyond now and no longer than max_days."""
    last = F.least(end, F.lit(now).cast("timestamp_ntz"))
    return F.greatest(start, last - F.expr(f"INTERVAL {max_days} DAYS")), last
