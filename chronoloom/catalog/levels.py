"""Scan, cleaning, hourly and index queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.operators import hourly as H
from chronoloom.operators.levels import VERSION, averaging, level, level_sql
from chronoloom.plans import index_levels
from chronoloom.sources.fixtures import OBS, observations

SUPPORTED = "('no2', 'pm25', 'pm10')"
#: Cleaned, hourly, filled and rolling rows, and index rows, as common table expressions.
CLEAN = f"""{OBS}, ok AS (SELECT * FROM obs WHERE pollutant_code IN {SUPPORTED} AND observed_at IS NOT NULL AND value >= 0),
clean AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id, observed_at ORDER BY seq DESC) AS rn FROM ok) WHERE rn = 1)"""
HOURLY = f"""{CLEAN}, hourly AS (SELECT connector_id, station_id, timeseries_id, pollutant_code, date_trunc('hour', observed_at) AS hour,
  avg(value) AS hourly_mean, count(value) AS sample_count FROM clean GROUP BY ALL)"""
FILLED = f"""{HOURLY}, spine AS (SELECT connector_id, station_id, timeseries_id, pollutant_code, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour
  FROM hourly WHERE pollutant_code IN ('pm25', 'pm10') GROUP BY connector_id, station_id, timeseries_id, pollutant_code),
filled AS (SELECT s.*, h.hourly_mean, h.sample_count, h.hour IS NULL AS synthetic FROM spine s LEFT JOIN hourly h ON s.timeseries_id = h.timeseries_id AND s.hour = h.hour
  UNION ALL SELECT *, false FROM hourly WHERE pollutant_code = 'no2')"""
ROLLING = f"""{FILLED}, rolled AS (SELECT *, avg(hourly_mean) OVER w AS rolling_mean, count(hourly_mean) OVER w AS rolling_count FROM filled
  WINDOW w AS (PARTITION BY timeseries_id ORDER BY hour RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW))"""
INDEX = f"""{ROLLING}, pre AS (SELECT *, CASE WHEN pollutant_code = 'no2' THEN hourly_mean ELSE rolling_mean END AS v,
  CASE WHEN pollutant_code = 'no2' THEN sample_count ELSE rolling_count END AS n, CASE WHEN pollutant_code = 'no2' THEN 1 ELSE 18 END AS req FROM rolled),
idx AS (SELECT * FROM (SELECT connector_id, station_id, timeseries_id, pollutant_code, hour, synthetic, v AS daqi_input_value,
  CASE WHEN pollutant_code = 'no2' THEN 'hourly_mean' ELSE 'rolling_24h_mean' END AS daqi_averaging,
  CASE WHEN v IS NOT NULL AND NOT (req > 1 AND n < req) THEN {level_sql("daqi", "v", "pollutant_code")} END AS daqi_level, n AS daqi_count, req AS daqi_required,
  CASE WHEN v IS NULL THEN 'missing_input' WHEN req > 1 AND n < req THEN 'insufficient_samples' ELSE 'ok' END AS daqi_status,
  CASE WHEN v IS NULL THEN 'no_input_value' WHEN req > 1 AND n < req THEN 'insufficient_rolling_24h_hours' END AS daqi_reason,
  hourly_mean AS eaqi_input_value, 'hourly_mean' AS eaqi_averaging, {level_sql("eaqi", "hourly_mean", "pollutant_code")} AS eaqi_level,
  sample_count AS eaqi_count, 1 AS eaqi_required, CASE WHEN hourly_mean IS NULL THEN 'missing_input' ELSE 'ok' END AS eaqi_status,
  CASE WHEN hourly_mean IS NULL THEN 'no_input_value' END AS eaqi_reason, sample_count AS hourly_sample_count, '{VERSION}' AS version
  FROM pre) WHERE NOT synthetic OR daqi_status = 'ok')"""
ROUNDED = "* REPLACE (round(daqi_input_value + 1e-9, 6) AS daqi_input_value, round(eaqi_input_value + 1e-9, 6) AS eaqi_input_value)"


def rounded(df, *columns):
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in columns})


def _index(df):
    return rounded(df, "daqi_input_value", "eaqi_input_value")


@register("p01_valid_observations", f"WITH {CLEAN} SELECT * FROM ok")
def _(spark, d):
    return H.valid(observations(spark, d))


@register("d05_last_row_wins", f"WITH {CLEAN} SELECT * FROM clean")
def _(spark, d):
    return H.last_wins(H.valid(observations(spark, d)))


@register("a01_hourly_means", f"WITH {HOURLY} SELECT * REPLACE (round(hourly_mean + 1e-9, 6) AS hourly_mean) FROM hourly")
def _(spark, d):
    return rounded(H.hourly_means(H.last_wins(H.valid(observations(spark, d)))), "hourly_mean")


@register("a02_hourly_means_hour_ending", f"""WITH {CLEAN} SELECT connector_id, station_id, timeseries_id, pollutant_code,
  date_trunc('hour', observed_at - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS hour, round(avg(value), 6) AS hourly_mean, count(value) AS sample_count FROM clean GROUP BY ALL""")
def _(spark, d):
    return rounded(H.hourly_means(H.last_wins(H.valid(observations(spark, d))), "end"), "hourly_mean")


@register("p02_valid_hourly", f"WITH {HOURLY} SELECT * REPLACE (round(hourly_mean + 1e-9, 6) AS hourly_mean) FROM hourly WHERE hourly_mean >= 0 AND sample_count > 0")
def _(spark, d):
    return rounded(H.valid_hourly(H.hourly_means(H.last_wins(H.valid(observations(spark, d))))), "hourly_mean")


@register("w02_gap_fill", f"WITH {FILLED} SELECT * REPLACE (round(hourly_mean + 1e-9, 6) AS hourly_mean) FROM filled")
def _(spark, d):
    return rounded(H.filled(H.hourly_means(H.last_wins(H.valid(observations(spark, d))))), "hourly_mean")


@register("w01_rolling_24h", f"WITH {ROLLING} SELECT * REPLACE (round(hourly_mean + 1e-9, 6) AS hourly_mean, round(rolling_mean + 1e-9, 6) AS rolling_mean) FROM rolled")
def _(spark, d):
    return rounded(H.rolling(H.filled(H.hourly_means(H.last_wins(H.valid(observations(spark, d)))))), "hourly_mean", "rolling_mean")


@register("d01_observations_to_index", f"WITH {INDEX} SELECT {ROUNDED} FROM (SELECT * EXCLUDE (synthetic) FROM idx)")
def _(spark, d):
    return _index(index_levels.from_observations(observations(spark, d)))


_DAYS = INDEX.replace("FROM events)", "FROM events WHERE ts >= TIMESTAMP '2024-01-09 01:00:00' AND ts < TIMESTAMP '2024-01-13')")


@register("d02_index_of_days_with_context", f"WITH {_DAYS} SELECT {ROUNDED} FROM (SELECT * EXCLUDE (synthetic) FROM idx) WHERE hour >= TIMESTAMP '2024-01-10' AND hour < TIMESTAMP '2024-01-13'")
def _(spark, d):
    """S-05..S-07 and P-04 too: the day before is read, days are cut out after the window."""
    return _index(index_levels.from_observations(observations(spark, d), "2024-01-10", "2024-01-12"))


@register("d03_hourly_to_index", f"WITH {INDEX} SELECT timeseries_id, pollutant_code, hour, daqi_level, eaqi_level, daqi_status FROM idx")
def _(spark, d):
    hours = H.hourly_means(H.last_wins(H.valid(observations(spark, d))))
    return index_levels.from_hourly(hours).select("timeseries_id", "pollutant_code", "hour", "daqi_level", "eaqi_level", "daqi_status")


@register("p04_one_day", f"WITH {HOURLY} SELECT timeseries_id, hour, sample_count FROM hourly WHERE hour >= TIMESTAMP '2024-01-10' AND hour < TIMESTAMP '2024-01-11'")
def _(spark, d):
    return H.on_day(H.hourly_means(H.last_wins(H.valid(observations(spark, d)))), "2024-01-10").select("timeseries_id", "hour", "sample_count")


@register("p03_range_and_cursor", f"WITH {OBS} SELECT * FROM obs WHERE observed_at >= TIMESTAMP '2024-01-05' AND observed_at < TIMESTAMP '2024-01-20' AND observed_at > TIMESTAMP '2024-01-07 12:00:00'")
def _(spark, d):
    return H.in_range(observations(spark, d), "2024-01-05", "2024-01-20", "2024-01-07 12:00:00")


@register("s03_one_series", f"WITH {OBS} SELECT observed_at, value FROM obs WHERE timeseries_id = 10")
def _(spark, d):
    return observations(spark, d).filter("timeseries_id = 10").select("observed_at", "value")


@register("s04_many_series", f"WITH {INDEX} SELECT timeseries_id, hour, daqi_level FROM idx WHERE timeseries_id IN (10, 21, 30)")
def _(spark, d):
    return index_levels.from_observations(observations(spark, d).filter(F.col("timeseries_id").isin(10, 21, 30))).select("timeseries_id", "hour", "daqi_level")


@register("f03_band_lookup", f"""WITH {OBS}, v AS (SELECT seq, pollutant_code, round(value) AS value FROM obs)
  SELECT seq, {level_sql("daqi", "value", "pollutant_code")} AS daqi, {level_sql("eaqi", "value", "pollutant_code")} AS eaqi,
  CASE WHEN pollutant_code = 'no2' THEN 'hourly_mean' ELSE 'rolling_24h_mean' END AS averaging FROM v""")
def _(spark, d):
    v, m = F.round("value"), F.col("pollutant_code")
    return observations(spark, d).select("seq", level("daqi", v, m).alias("daqi"), level("eaqi", v, m).alias("eaqi"), averaging(m).alias("averaging"))


@register("w00_target_day_over_context", f"""WITH {HOURLY} SELECT timeseries_id, hour, source, sample_count FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id, hour ORDER BY p) AS rn FROM (
  SELECT timeseries_id, hour, sample_count, 'target' AS source, 0 AS p FROM hourly WHERE hour >= TIMESTAMP '2024-01-10' AND hour < TIMESTAMP '2024-01-11'
  UNION ALL SELECT timeseries_id, hour, sample_count, 'context', 1 FROM hourly WHERE hour >= TIMESTAMP '2024-01-09' AND hour < TIMESTAMP '2024-01-11')) WHERE rn = 1""")
def _(spark, d):
    """U-04."""
    from chronoloom.operators.sets import prefer

    hours = H.hourly_means(H.last_wins(H.valid(observations(spark, d)))).select("timeseries_id", "hour", "sample_count")
    context = H.in_range(hours, "2024-01-09", "2024-01-11", column="hour").withColumn("source", F.lit("context"))
    return prefer(H.on_day(hours, "2024-01-10").withColumn("source", F.lit("target")), context, ["timeseries_id", "hour"])
