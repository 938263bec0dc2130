"""One series from several sources, for many series at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.operators.sets import prefer
from chronoloom.operators.windows import merged_intervals

KEYS = ["timeseries_id", "observed_at"]


def fill_slices(primary: DataFrame, wanted: DataFrame, start: str, end: str, tail_hours: int) -> tuple[DataFrame, DataFrame]:
    """What the secondary source is asked for, and what is skipped: head and tail that the primary does not cover, or all
    of an empty series; nothing older than tail_hours before the end."""
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    have = primary.filter((F.col("observed_at") >= a) & (F.col("observed_at") < b)).groupBy("timeseries_id").agg(F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))
    one = lambda lo, hi, why: F.struct(lo.alias("start"), hi.alias("end"), F.lit(why).alias("reason"))
    empty = F.array(one(a, b, "empty_window"))
    both = F.array(one(a, F.col("first"), "uncovered_head"), one(F.col("last") + F.expr("INTERVAL 1 MILLISECOND"), b, "uncovered_tail"))
    cand = wanted.join(have, "timeseries_id", "left").select("timeseries_id", F.explode(F.when(F.col("first").isNull(), empty).otherwise(both)).alias("s")).select("timeseries_id", "s.*").filter("start < end")
    cap = b - F.expr(f"INTERVAL {tail_hours} HOURS")
    asked = cand.withColumn("start", F.greatest("start", cap)).filter("start < end")
    skipped = cand.filter(F.col("start") < cap).select("timeseries_id", "start", F.least("end", cap).alias("end"), F.concat("reason", F.lit("_outside_tail_cap")).alias("reason"))
    return merged_intervals(asked, ["timeseries_id"]), skipped


def stitched(primary: DataFrame, secondary: DataFrame, slices: DataFrame, start: str, end: str) -> DataFrame:
    """(timeseries_id, observed_at, value, source) of the window: the primary's rows, and the secondary's inside slices."""
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    cut = lambda df: df.filter((F.col("observed_at") >= a) & (F.col("observed_at") < b)).groupBy(*KEYS).agg(F.max("value").alias("value"))
    s = slices.select("timeseries_id", F.col("start").alias("lo"), F.col("end").alias("hi"))
    fill = cut(secondary).join(s, "timeseries_id").filter("observed_at >= lo and observed_at < hi").select(*KEYS, "value").distinct()
    return prefer(cut(primary).withColumn("source", F.lit("primary")), fill.withColumn("source", F.lit("secondary")), KEYS)


def first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows of each series by time, the total before, and whether rows were left out."""
    from pyspark.sql import Window

    w = Window.partitionBy("timeseries_id")
    out = rows.withColumns({"rn": F.row_number().over(w.orderBy("observed_at")), "total": F.count("*").over(w)})
    return out.filter(F.col("rn") <= n).withColumn("limited", F.col("total") > n).drop("rn")


def cursors(rows: DataFrame, order: str = "observed_at", tie: str = "seq") -> DataFrame:
    """Per series the largest time, and among its rows the largest tie value."""
    return rows.groupBy("timeseries_id").agg(F.max(F.struct(order, tie)).alias("c")).select("timeseries_id", "c.*")


def stable_head(stored: DataFrame, live: DataFrame) -> DataFrame:
    """Per series: rows that both have, and those whose values differ."""
    both = stored.select(*KEYS, F.col("value").alias("s")).join(live.select(*KEYS, F.col("value").alias("l")), KEYS, "full_outer")
    return both.groupBy("timeseries_id").agg(F.count_if(F.col("s").isNotNull() & F.col("l").isNotNull()).alias("overlap"), F.count_if(F.col("s") != F.col("l")).alias("mismatches"), F.count("*").alias("merged"))


def conflicts(rows: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """The first row of each key, and whether others of it differ."""
    out = rows.groupBy(*keys).agg(F.min_by(F.struct(*fields), order).alias("f"), F.count_distinct(F.struct(*fields)).alias("n"))
    return out.select(*keys, "f.*", (F.col("n") > 1).alias("conflict"))
