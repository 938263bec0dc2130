"""Index levels: break-point tables as data, compiled into CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper ends of the bands of each scale and measure, from level 1 on; the last level has none. Fixed values.
BANDS = {
    "daqi": {
        "no2": (67, 134, 200, 267, 334, 400, 467, 534, 600),
        "pm25": (11, 23, 35, 41, 47, 53, 58, 64, 70),
        "pm10": (16, 33, 50, 58, 66, 75, 83, 91, 100),
    },
    "eaqi": {"no2": (10, 25, 60, 100, 150), "pm25": (5, 15, 50, 90, 140), "pm10": (15, 45, 120, 195, 270)},
}
REQUIRED_HOURS, VERSION = 18, "hourly_levels_1"


def level(scale: str, value: Column, measure: Column) -> Column:
    """The first band whose upper end, included, is not below the value; null below 0 and without a value."""
    out = F.when(value.isNull() | F.isnan(value) | (value < 0), F.lit(None).cast("int"))
    for m, uppers in BANDS[scale].items():
        for i, upper in enumerate(uppers):
            out = out.when((measure == m) & (value <= upper), F.lit(i + 1))
        out = out.when(measure == m, F.lit(len(uppers) + 1))
    return out


def status(value: Column, count: Column, required: Column) -> tuple[Column, Column]:
    """Calculation status and the reason of a missing level."""
    missing, few = value.isNull() | F.isnan(value), (required > 1) & (F.coalesce(count, F.lit(0)) < required)
    return (
        F.when(missing, "missing_input").when(few, "insufficient_samples").otherwise("ok"),
        F.when(missing, "no_input_value").when(few, "insufficient_rolling_24h_hours"),
    )


def averaging(measure: Column) -> Column:
    return F.when(measure == "no2", "hourly_mean").otherwise("rolling_24h_mean")


def index_rows(hours: DataFrame) -> DataFrame:
    """Hourly rows with rolling windows to index rows on both scales. Rows made by gap filling stay only if the first
    scale's status is ok."""
    m = F.col("pollutant_code")
    gas = m == "no2"
    value = F.when(gas, F.col("hourly_mean")).otherwise(F.col("rolling_mean"))
    count = F.when(gas, F.col("sample_count")).otherwise(F.col("rolling_count"))
    required = F.when(gas, F.lit(1)).otherwise(F.lit(REQUIRED_HOURS))
    d_status, d_reason = status(value, count, required)
    e_status, e_reason = status(F.col("hourly_mean"), F.col("sample_count"), F.lit(1))
    out = hours.select(
        "connector_id", "station_id", "timeseries_id", "pollutant_code", "hour", "synthetic",
        value.alias("daqi_input_value"), averaging(m).alias("daqi_averaging"),
        F.when(d_status == "ok", level("daqi", value, m)).alias("daqi_level"), count.cast("long").alias("daqi_count"), required.alias("daqi_required"),
        d_status.alias("daqi_status"), d_reason.alias("daqi_reason"),
        F.col("hourly_mean").alias("eaqi_input_value"), F.lit("hourly_mean").alias("eaqi_averaging"),
        F.when(e_status == "ok", level("eaqi", F.col("hourly_mean"), m)).alias("eaqi_level"), F.col("sample_count").cast("long").alias("eaqi_count"), F.lit(1).alias("eaqi_required"),
        e_status.alias("eaqi_status"), e_reason.alias("eaqi_reason"),
        F.col("sample_count").cast("long").alias("hourly_sample_count"), F.lit(VERSION).alias("version"),
    )
    return out.filter("not synthetic or daqi_status = 'ok'").drop("synthetic")


def level_sql(scale: str, value: str, measure: str) -> str:
    """The same CASE as SQL text."""
    when = "".join(f" WHEN {measure} = '{m}' AND {value} <= {u} THEN {i + 1}" for m, us in BANDS[scale].items() for i, u in enumerate(us))
    rest = "".join(f" WHEN {measure} = '{m}' THEN {len(us) + 1}" for m, us in BANDS[scale].items())
    return f"CASE WHEN {value} IS NULL OR {value} < 0 THEN NULL{when}{rest} END"
