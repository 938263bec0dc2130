"""Daily, rolling-year and calendar-year guideline status. Thresholds and guidelines are parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions.time import closed_day, hour_start
from chronoloom.operators.hourly import SUPPORTED

#: measure -> (daily, yearly guideline). Fixed values.
GUIDELINES = {"pm25": (15.0, 5.0), "pm10": (45.0, 15.0), "no2": (25.0, 10.0)}
MIN_HOURS, MIN_DAYS, ALLOWANCE = 18, 274, 3
KEYS = ["connector_id", "station_id", "timeseries_id", "pollutant_code"]


def guideline(i: int, measure: str = "pollutant_code"):
    return F.coalesce(*[F.when(F.col(measure) == m, F.lit(g[i])) for m, g in GUIDELINES.items()])


def daily_means(obs: DataFrame, min_hours: int = MIN_HOURS) -> DataFrame:
    """The mean of hourly means of each series and day (D 00:00, D+1 00:00]; hours are floored, so midnight of D+1 is an
    hour of its own. Null below min_hours; a series with only invalid values has a row with no hours."""
    seen = obs.filter(F.col("pollutant_code").isin(*SUPPORTED)).withColumn("day", closed_day("observed_at"))
    good = F.when((F.col("value") >= 0) & ~F.isnan("value"), F.col("value"))
    hours = seen.groupBy(*KEYS, "day", hour_start("observed_at").alias("hour")).agg(F.avg(good).alias("m"))
    out = hours.groupBy(*KEYS, "day").agg(F.count("m").alias("valid_hours"), F.avg("m").alias("mean"))
    return out.withColumn("daily_mean", F.when(F.col("valid_hours") >= min_hours, F.col("mean"))).drop("mean")


def daily_status(days: DataFrame, first: str, last: str, min_hours: int = MIN_HOURS) -> DataFrame:
    """Every series and day of [first, last] with its status and completeness; days without a row are no_data."""
    spine = days.select(*KEYS).distinct().withColumn("day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    out = spine.join(days, [*KEYS, "day"], "left")
    enough = F.coalesce(F.col("valid_hours") >= min_hours, F.lit(False))
    above = F.when(enough, F.col("daily_mean") > guideline(0))
    status = F.when(F.col("valid_hours").isNull(), "no_data").when(~enough, "not_enough_data").when(above, "above_guideline").otherwise("within_guideline")
    share = F.round(F.least(F.lit(100.0), 100.0 * F.coalesce("valid_hours", F.lit(0)) / 24) + 1e-9, 1)
    return out.withColumns({"has_enough_data": enough, "above_daily": above, "status": status, "completeness": share})


def _period(out: DataFrame, min_days) -> DataFrame:
    enough = F.col("valid_days") >= min_days
    return out.withColumns({
        "min_days": min_days, "has_enough_data": enough,
        "above_yearly": F.when(enough, F.col("period_mean") > guideline(1)),
        "above_daily_approach": F.when(enough, F.col("days_above") > ALLOWANCE),
    })


def rolling_year(days: DataFrame, n: int = 365, min_days: int = MIN_DAYS) -> DataFrame:
    """At each day of a series, the n days up to it: mean of daily means, valid days, hours and days above."""
    w = Window.partitionBy(*KEYS).orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-(n - 1), 0)
    above = F.when(F.col("daily_mean") > guideline(0), 1).otherwise(0)
    out = days.select(*KEYS, F.col("day").alias("as_of"), F.avg("daily_mean").over(w).alias("period_mean"), F.count("daily_mean").over(w).alias("valid_days"), F.sum("valid_hours").over(w).alias("valid_hours"), F.sum(above).over(w).alias("days_above"))
    return _period(out, F.lit(min_days))


def calendar_year(days: DataFrame, last_day: str, min_days: int = MIN_DAYS) -> DataFrame:
    """A row a series and year: complete years at min_days, the year of last_day at least(n, greatest(14, ceil(0.75 n)))."""
    last = F.lit(last_day).cast("date")
    above = F.when(F.col("daily_mean") > guideline(0), 1).otherwise(0)
    out = days.filter(F.col("day") <= last).groupBy(*KEYS, F.year("day").alias("year")).agg(F.avg("daily_mean").alias("period_mean"), F.count("daily_mean").alias("valid_days"), F.sum(above).alias("days_above"))
    ends = F.make_date("year", F.lit(12), F.lit(31))
    out = out.withColumn("period_days", F.datediff(F.least(ends, last), F.make_date("year", F.lit(1), F.lit(1))) + 1)
    n = F.col("period_days")
    scaled = F.least(n, F.greatest(F.lit(14), F.ceil(n * 0.75).cast("int")))
    out = out.withColumn("kind", F.when(ends <= last, "complete_year").otherwise("year_to_date"))
    return _period(out, F.when(F.col("kind") == "complete_year", F.lit(min_days)).otherwise(scaled))


def cards(years: DataFrame, days: DataFrame) -> DataFrame:
    """Per measure and kind of card: series with data, above, within, percent above."""
    part = lambda df, kind, flag: df.select("pollutant_code", F.lit(kind).alias("card"), F.col(flag).alias("above"))
    every = part(years, "yearly", "above_yearly").unionByName(part(years, "daily_approach", "above_daily_approach")).unionByName(part(days, "daily", "above_daily"))
    out = every.groupBy("pollutant_code", "card").agg(F.count("above").alias("with_data"), F.count_if("above").alias("above"), F.count_if(~F.col("above")).alias("within"))
    return out.withColumn("percent_above", F.when(F.col("with_data") > 0, F.round(100.0 * F.col("above") / F.col("with_data") + 1e-9, 1)))


def readiness(obs: DataFrame, eligible: DataFrame, hour: str) -> DataFrame:
    """Per measure: eligible series, those that reported in the hour from `hour` on, their share; all_ready over all."""
    final = F.lit(hour).cast("timestamp_ntz")
    have = obs.filter((F.col("observed_at") >= final) & (F.col("observed_at") < final + F.expr("INTERVAL 1 HOUR"))).select("timeseries_id").distinct().withColumn("r", F.lit(1))
    out = eligible.join(have, "timeseries_id", "left").groupBy("pollutant_code").agg(F.count("*").alias("eligible"), F.count("r").alias("ready"))
    out = out.withColumns({"share": F.round(F.col("ready") / F.col("eligible") + 1e-9, 4), "is_ready": F.col("ready") == F.col("eligible")})
    return out.crossJoin(F.broadcast(out.agg(F.bool_and("is_ready").alias("all_ready"), F.bool_or("is_ready").alias("any_ready"))))  # one row
