"""Observations to index rows as one lazy plan. All steps share the series as key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.hourly import filled, hourly_means, last_wins, rolling, valid, valid_hourly
from chronoloom.operators.levels import index_rows


def from_hourly(hours: DataFrame) -> DataFrame:
    """Hourly rows (series, hour, hourly_mean, sample_count) to index rows."""
    return index_rows(rolling(filled(valid_hourly(hours))))


def from_observations(obs: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Index rows of the days from first_day to last_day. The day before is read too, for the rolling window, and the
    days are cut out after it."""
    if first_day:
        start = F.lit(first_day).cast("timestamp_ntz")
        end = F.date_add(F.lit(last_day or first_day).cast("date"), 1)
        obs = obs.filter((F.col("observed_at") >= start - F.expr("INTERVAL 23 HOURS")) & (F.col("observed_at") < end))
    out = from_hourly(hourly_means(last_wins(valid(obs))))
    return out.filter((F.col("hour") >= start) & (F.col("hour") < end)) if first_day else out
