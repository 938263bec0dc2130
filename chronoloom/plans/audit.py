"""Audit reports: hour spines against two fact sets, gaps, duplicates, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.time import hour_start


def spine(keys: DataFrame, start: str, end: str) -> DataFrame:
    """Each row of keys with each hour of [start, end)."""
    last = F.lit(end).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    return keys.withColumn("hour", F.explode(F.sequence(F.lit(start).cast("timestamp_ntz"), last, F.expr("INTERVAL 1 HOUR"))))


def aligned(obs: DataFrame, index: DataFrame, start: str, end: str) -> DataFrame:
    """Per series and hour: observations, index rows, and what is wrong."""
    per_hour = obs.groupBy("timeseries_id", hour_start("observed_at").alias("hour")).agg(F.count("*").alias("obs_rows"))
    levels = index.groupBy("timeseries_id", "hour").agg(F.count("*").alias("index_rows"), F.max("daqi_level").alias("daqi_level"), F.max("eaqi_level").alias("eaqi_level"))
    grid = spine(per_hour.select("timeseries_id").distinct(), start, end)  # from the counts: observations are read once less
    out = grid.join(per_hour, ["timeseries_id", "hour"], "left").join(levels, ["timeseries_id", "hour"], "left")
    o, i = F.coalesce("obs_rows", F.lit(0)), F.coalesce("index_rows", F.lit(0))
    d, e = F.col("daqi_level"), F.col("eaqi_level")
    status = (
        F.when((o > 0) & (i > 0) & d.isNotNull() & e.isNotNull(), "ok").when((o > 0) & (i == 0), "observations_without_index").when((o == 0) & (i > 0), "index_without_observations")
        .when((i > 0) & d.isNull() & e.isNull(), "both_levels_missing").when((i > 0) & d.isNull(), "first_level_missing").when((i > 0) & e.isNull(), "second_level_missing")
        .when((o == 0) & (i == 0), "no_data").otherwise("other")
    )
    return out.select("timeseries_id", "hour", o.alias("obs_rows"), i.alias("index_rows"), "daqi_level", "eaqi_level", (i > 1).alias("duplicate_index"), status.alias("status"))


def summary(alignment: DataFrame) -> DataFrame:
    """Labelled counts of the whole alignment, one row each."""
    one = alignment.agg(F.count("*").alias("hours"), F.count_if(F.col("obs_rows") > 0).alias("hours_with_observations"), F.count_if(F.col("index_rows") > 0).alias("hours_with_index"), F.count_if(F.col("status") == "ok").alias("hours_ok"))
    return one.unpivot([], one.columns, "label", "n")


def day_coverage(alignment: DataFrame) -> DataFrame:
    """Per series and day: hours, hours of each kind, first hour without an index row."""
    return alignment.groupBy("timeseries_id", F.to_date("hour").alias("day")).agg(
        F.count("*").alias("hours"), F.count_if(F.col("obs_rows") > 0).alias("with_observations"), F.count_if(F.col("index_rows") > 0).alias("with_index"),
        F.min(F.when((F.col("obs_rows") > 0) & (F.col("index_rows") == 0), F.col("hour"))).alias("first_missing"),
    )


def duplicates(rows: DataFrame, keys: list[str], named: str) -> DataFrame:
    """Keys of more than one row: rows, distinct values of `named` and their ordered list."""
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(named).alias("n_distinct"), F.array_join(F.array_sort(F.collect_set(F.col(named).cast("string"))), ",").alias("listed"))
    return out.filter("n > 1")


def column_counts(rows: DataFrame, columns: list[str], null: str = "unknown") -> DataFrame:
    """(column, value, n) for several columns at once."""
    cast = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null)).alias(c) for c in columns])
    return cast.unpivot([], columns, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))


def missing_hours(obs: DataFrame, start: str, end: str) -> DataFrame:
    """Per series: expected and present hours, the missing ones, complete."""
    have = obs.select("timeseries_id", hour_start("observed_at").alias("hour")).distinct().withColumn("have", F.lit(1))
    grid = spine(have.select("timeseries_id").distinct(), start, end).join(have, ["timeseries_id", "hour"], "left")
    out = grid.groupBy("timeseries_id").agg(F.count("*").alias("expected"), F.count("have").alias("present"), F.array_sort(F.collect_list(F.when(F.col("have").isNull(), F.date_format("hour", "yyyy-MM-dd HH")))).alias("gaps"))
    return out.select("timeseries_id", "expected", "present", F.array_join("gaps", ",").alias("missing"), (F.col("expected") == F.col("present")).alias("complete"))
