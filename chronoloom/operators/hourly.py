"""From observations to hourly rows: cleaning, means, gap filling and rolling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions.time import hour_end, hour_number, hour_start

SUPPORTED, FILLED = ("no2", "pm25", "pm10"), ("pm25", "pm10")
SERIES = ["connector_id", "station_id", "timeseries_id", "pollutant_code"]


def valid(obs: DataFrame, measures=SUPPORTED) -> DataFrame:
    """Positive ids, a known measure, a time, and a value that is a number of 0 or more."""
    ids = (F.col("connector_id") > 0) & (F.col("station_id") > 0) & (F.col("timeseries_id") > 0)
    return obs.filter(ids & F.col("pollutant_code").isin(*measures) & F.col("observed_at").isNotNull() & (F.col("value") >= 0) & ~F.isnan("value"))


def last_wins(obs: DataFrame) -> DataFrame:
    """One row for a series and time: the one of the greatest seq. A grouping, so that repeats are combined before the shuffle."""
    rest = [c for c in obs.columns if c not in ("timeseries_id", "observed_at")]
    row = F.max_by(F.struct(*rest), "seq").alias("r")
    return obs.groupBy("timeseries_id", "observed_at").agg(row).select(*[F.col(c) if c in ("timeseries_id", "observed_at") else F.col(f"r.{c}") for c in obs.columns])


def hourly_means(obs: DataFrame, convention: str = "start") -> DataFrame:
    """Mean and count of each series and hour, the hour named by its start or its end."""
    hour = hour_start("observed_at") if convention == "start" else hour_end("observed_at")
    return obs.groupBy(*SERIES, hour.alias("hour")).agg(F.avg("value").alias("hourly_mean"), F.count("value").alias("sample_count"))


def valid_hourly(hours: DataFrame) -> DataFrame:
    return hours.filter((F.col("hourly_mean") >= 0) & (F.col("sample_count") > 0))


def filled(hours: DataFrame, measures=FILLED) -> DataFrame:
    """All hours from the first to the last of each series of the given measures; other series as they are. Adds
    synthetic. Each row is followed by the hours up to the next one: one window by series, which rolling frames share."""
    after = F.lead("hour").over(Window.partitionBy(*SERIES).orderBy("hour")) - F.expr("INTERVAL 1 HOUR")
    last = F.when(F.col("pollutant_code").isin(*measures), F.greatest("hour", F.col("__last"))).otherwise(F.col("hour"))
    each = hours.withColumn("__last", after).withColumn("__hour", F.explode(F.sequence("hour", F.coalesce(last, "hour"), F.expr("INTERVAL 1 HOUR"))))
    own = F.col("__hour") == F.col("hour")
    rest = [c for c in hours.columns if c not in (*SERIES, "hour")]
    return each.select(*SERIES, F.col("__hour").alias("hour"), *[F.when(own, F.col(c)).alias(c) for c in rest], (~own).alias("synthetic"))


def rolling(hours: DataFrame, n: int = 24) -> DataFrame:
    """Adds the mean over the last n hours, the row's own included, and how many of them have a mean."""
    w = Window.partitionBy(*SERIES).orderBy(hour_number("hour")).rangeBetween(-(n - 1), 0)
    return hours.withColumns({"rolling_mean": F.avg("hourly_mean").over(w), "rolling_count": F.count("hourly_mean").over(w)})


def on_day(rows: DataFrame, day: str, column: str = "hour") -> DataFrame:
    """Rows of one UTC day [D, D + 1)."""
    return rows.filter((F.col(column) >= F.lit(day).cast("date")) & (F.col(column) < F.date_add(F.lit(day).cast("date"), 1)))


def in_range(rows: DataFrame, start, end, after=None, column: str = "observed_at") -> DataFrame:
    """[start, end), and later than `after`."""
    c = F.col(column)
    out = rows.filter((c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz")))
    return out if after is None else out.filter(c > F.lit(after).cast("timestamp_ntz"))
