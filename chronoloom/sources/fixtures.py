"""Views that give the driver's star-schema tables the shapes of a sensor network, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: event type -> (number, measure). Fixed values.
TYPES = {"click": (1, "pm25"), "view": (2, "pm10"), "purchase": (3, "no2"), "error": (4, "o3")}
OTHER = (5, "temperature")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(i: int):
    out = F.when(F.lit(False), F.lit(OTHER[i]))
    for kind, row in TYPES.items():
        out = out.when(F.col("event_type") == kind, F.lit(row[i]))
    return out.otherwise(F.lit(OTHER[i]))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(connector_id, station_id, timeseries_id, pollutant_code, observed_at, value, seq) from events."""
    return as_observations(table(spark, sf_dir, "events"))


def as_observations(e: DataFrame) -> DataFrame:
    odd = F.col("user_id") % 2
    return e.select(
        (1 + odd).cast("int").alias("connector_id"),
        (100 + _case(0)).cast("int").alias("station_id"),
        (10 * _case(0) + odd).cast("int").alias("timeseries_id"),
        _case(1).alias("pollutant_code"),
        F.col("ts").alias("observed_at"),
        "value",
        F.col("event_id").alias("seq"),
    )


def store_b(obs: DataFrame) -> DataFrame:
    """A second copy: rows are missing (seq % 97 = 0), changed (89), added an hour later (83) and repeated (79)."""
    kept = obs.filter("seq % 97 <> 0").withColumn("value", F.when(F.col("seq") % 89 == 0, F.col("value") + 1).otherwise(F.col("value")))
    extra = obs.filter("seq % 83 = 0").withColumns({"observed_at": F.col("observed_at") + F.expr("INTERVAL 1 HOUR"), "seq": F.col("seq") + 10_000_000})
    return kept.unionByName(extra).unionByName(kept.filter("seq % 79 = 0"))


def bindings(obs: DataFrame, left_out: int = 51) -> DataFrame:
    """What each series belongs to; one series is unknown, so that inner joins drop rows."""
    return obs.select("timeseries_id", "connector_id", "station_id", "pollutant_code").distinct().filter(F.col("timeseries_id") != left_out)


def members(obs: DataFrame) -> DataFrame:
    """Validity of series by station: the even series to mid January, the odd one from then on, without end."""
    first = F.col("timeseries_id") % 2 == 0
    return obs.select("station_id", "timeseries_id").distinct().select(
        "station_id", "timeseries_id",
        F.when(first, F.lit("2024-01-01")).otherwise(F.lit("2024-01-16")).cast("date").alias("valid_from"),
        F.when(first, F.lit("2024-01-15")).cast("date").alias("valid_to"),
    )


_N = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {n}" for k, (n, _) in TYPES.items()) + f" ELSE {OTHER[0]} END"
_M = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, (_, m) in TYPES.items()) + f" ELSE '{OTHER[1]}' END"

#: The same views as common table expressions.
OBS = f"""obs AS (SELECT CAST(1 + user_id % 2 AS INTEGER) AS connector_id, CAST(100 + {_N} AS INTEGER) AS station_id,
  CAST(10 * {_N} + user_id % 2 AS INTEGER) AS timeseries_id, {_M} AS pollutant_code, ts AS observed_at, value, event_id AS seq FROM events)"""
STORE_B = """kept AS (SELECT * REPLACE (CASE WHEN seq % 89 = 0 THEN value + 1 ELSE value END AS value) FROM obs WHERE seq % 97 <> 0),
store_b AS (SELECT * FROM kept UNION ALL
  SELECT * REPLACE (observed_at + INTERVAL 1 HOUR AS observed_at, seq + 10000000 AS seq) FROM obs WHERE seq % 83 = 0
  UNION ALL SELECT * FROM kept WHERE seq % 79 = 0)"""
BINDINGS = "bindings AS (SELECT DISTINCT timeseries_id, connector_id, station_id, pollutant_code FROM obs WHERE timeseries_id <> 51)"
MEMBERS = """members AS (SELECT DISTINCT station_id, timeseries_id,
  CASE WHEN timeseries_id % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-16' END AS valid_from,
  CASE WHEN timeseries_id % 2 = 0 THEN DATE '2024-01-15' END AS valid_to FROM obs)"""
