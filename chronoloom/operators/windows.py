"""Gaps, islands, intervals and change detection. Every window is partitioned by a series or key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions.time import hour_number

OPEN_END = "9999-12-31"


def islands(rows: DataFrame, keys: list[str], hour: str = "hour") -> DataFrame:
    """Runs of consecutive hours with equal keys: start, end (of the last hour) and hours."""
    w = Window.partitionBy(*keys).orderBy(hour)
    run = rows.select(*keys, hour).withColumn("__g", hour_number(hour) - F.row_number().over(w))
    return run.groupBy(*keys, "__g").agg(F.min(hour).alias("start"), (F.max(hour) + F.expr("INTERVAL 1 HOUR")).alias("end"), F.count("*").alias("hours")).drop("__g")


def merged_intervals(rows: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping or touching intervals of a key as one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.filter(F.col(start) < F.col(end)).withColumn("__new", (before.isNull() | (F.col(start) > before)).cast("int"))
    marked = marked.withColumn("__i", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "__i").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__i")


def hour_windows(hours: DataFrame, keys: list[str], context: int, hour: str = "hour") -> DataFrame:
    """Missing hours as windows that begin `context` hours earlier, merged."""
    step = hours.select(*keys, (F.col(hour) - F.expr(f"INTERVAL {context} HOURS")).alias("start"), (F.col(hour) + F.expr("INTERVAL 1 HOUR")).alias("end"))
    return merged_intervals(step, keys)


def time_gaps(rows: DataFrame, start, end, floor_seconds: int, key: str = "timeseries_id", ts: str = "observed_at") -> DataFrame:
    """Ranges without a row, in [start, end]: wider than max(1.6 e, e + 20 min), e being the larger of floor_seconds and
    the upper median of the series' positive steps. Series with fewer than two times have none. The median is taken from
    counts of distinct steps, so that no series is gathered in one row."""
    start, end = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    seconds = lambda a, b: F.unix_micros(b.cast("timestamp")) / 1e6 - F.unix_micros(a.cast("timestamp")) / 1e6
    w = Window.partitionBy(key).orderBy(ts)
    step = rows.select(key, ts).distinct().withColumns({"before": F.lag(ts).over(w), "after": F.lead(ts).over(w)}).withColumn("step", seconds(F.col("before"), F.col(ts)))
    n = step.filter("step > 0").groupBy(key, "step").agg(F.count("*").alias("n"))
    up = Window.partitionBy(key).orderBy("step")
    n = n.withColumns({"to": F.sum("n").over(up), "all": F.sum("n").over(Window.partitionBy(key))})
    median = n.filter("to > floor(all / 2)").groupBy(key).agg(F.min("step").alias("median"))
    e = F.greatest(F.lit(float(floor_seconds)), F.col("median"))
    limit = median.select(key, F.greatest(e * 1.6, e + 1200).alias("limit"))
    # Each time gives the gap before it, and those at the ends of the range if it is a series' first or last.
    gap = lambda when, a, b: F.when(when & (seconds(a, b) > F.col("limit")), F.struct(a.alias("start"), b.alias("end")))
    now, before, after = F.col(ts), F.col("before"), F.col("after")
    gaps = F.array_compact(F.array(gap(before.isNull(), start, now), gap(before.isNotNull(), before, now), gap(after.isNull(), now, end)))
    return step.join(limit, key).select(key, F.inline(gaps))


def changes(rows: DataFrame, key: str, order: list[str], state: list[str]) -> DataFrame:
    """Rows whose state differs from the row before of the same key, the first included."""
    w = Window.partitionBy(key).orderBy(*order)
    now = F.struct(*state)
    return rows.withColumn("__b", F.lag(now).over(w)).filter(~F.col("__b").eqNullSafe(now)).drop("__b")


def closed_intervals(rows: DataFrame, key: str, start: str, end: str | None = None) -> DataFrame:
    """Adds until: the smaller of the row's own end and the day before the next start; inverted rows go."""
    w = Window.partitionBy(key).orderBy(start)
    following = F.date_sub(F.lead(start).over(w), 1)
    until = following if end is None else F.least(F.col(end), following)
    return rows.withColumn("until", until).filter(F.col("until").isNull() | (F.col("until") >= F.col(start)))


def swept(rows: DataFrame, keys: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Adds before: the furthest end (open ones without limit) among the intervals of the key that start earlier, or
    start with this one and come before it; and overlapping, whether the interval begins by then. Inverted intervals cover
    nothing and overlap nothing."""
    last = F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))
    w = Window.partitionBy(*keys).orderBy(F.col(start), last).rowsBetween(Window.unboundedPreceding, -1)
    upright = last >= F.col(start)
    out = rows.withColumn("before", F.max(F.when(upright, last)).over(w))
    return out.withColumn("overlapping", F.coalesce(upright & (F.col(start) <= F.col("before")), F.lit(False)))


def interval_faults(rows: DataFrame, key: str | list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """(key, overlaps, open_ends, valid): intervals may not overlap any other, and one at most is open. An interval counts
    once if one that starts before it, or with it, still holds."""
    keys = [key] if isinstance(key, str) else key
    out = swept(rows, keys, start, end).groupBy(*keys).agg(F.count_if("overlapping").alias("overlaps"), F.count_if(F.col(end).isNull()).alias("open_ends"))
    return out.withColumn("valid", (F.col("overlaps") == 0) & (F.col("open_ends") <= 1))


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of the greatest order of each key; a grouping, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*")


def numbered_chunks(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """Adds chunk: rows of a key in order, n at a time, from 0."""
    return rows.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / n))
