"""Joins on validity intervals. Each has an equality on a key, so that Spark hashes and sorts instead of looping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.operators.windows import OPEN_END


def _end(c: str):
    return F.coalesce(F.col(c), F.lit(OPEN_END).cast("date"))


def member_at(rows: DataFrame, members: DataFrame, key: str, ts: str, moment=None) -> DataFrame:
    """rows with the member's series that is valid at ts (or at `moment`, an expression); rows without one go."""
    at = F.to_date(F.col(ts) if moment is None else moment)
    m = members.select(F.col(key).alias("__k"), F.col("timeseries_id").alias("member_id"), "valid_from", _end("valid_to").alias("__to"))
    return rows.join(m, (F.col(key) == F.col("__k")) & (at >= F.col("valid_from")) & (at <= F.col("__to"))).drop("__k", "__to", "valid_from")


def clipped(members: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The parts of [start, end) that members cover, and the gaps between them (no series)."""
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    lo, hi = F.col("valid_from").cast("timestamp_ntz"), F.when(F.col("valid_to").isNull(), b).otherwise(F.date_add("valid_to", 1).cast("timestamp_ntz"))
    seg = members.select(key, "timeseries_id", F.greatest(lo, a).alias("start"), F.least(hi, b).alias("end")).filter("start < end")
    w = Window.partitionBy(key).orderBy("start")
    before = F.coalesce(F.lag("end").over(w), a)
    gap = seg.withColumn("b", before).filter("b < start").select(key, F.lit(None).cast("int").alias("timeseries_id"), F.col("b").alias("start"), F.col("start").alias("end"))
    last = seg.groupBy(key).agg(F.max("end").alias("m")).filter(F.col("m") < b).select(key, F.lit(None).cast("int").alias("timeseries_id"), F.col("m").alias("start"), b.alias("end"))
    return seg.unionByName(gap).unionByName(last)


def days_covered(days: DataFrame, intervals: DataFrame, key: str, day: str, start: str, end: str) -> DataFrame:
    """Each (key, day) with how many intervals hold it, and the state of one; more than one is an error."""
    i = intervals.select(F.col(key).alias("__k"), "state", F.col(start).alias("__a"), _end(end).alias("__b"))
    out = days.join(i, (F.col(key) == F.col("__k")) & F.col(day).between(F.col("__a"), F.col("__b")), "left")
    out = out.groupBy(key, day).agg(F.count("__a").alias("intervals"), F.max("state").alias("state"))
    return out.withColumn("fault", F.col("intervals") > 1)


def overlaps(rows: DataFrame, link: str, ident: str, start: str, end: str) -> DataFrame:
    """Pairs of one link key whose intervals overlap, the days in common, and how the two relate."""
    a = rows.select(F.col(link), F.col(ident).alias("a"), F.col(start).alias("a_start"), _end(end).alias("a_end"))
    b = rows.select(F.col(link), F.col(ident).alias("b"), F.col(start).alias("b_start"), _end(end).alias("b_end"))
    out = a.join(b, link).filter("a < b and a_start <= b_end and b_start <= a_end")
    days = F.datediff(F.least("a_end", "b_end"), F.greatest("a_start", "b_start")) + 1
    kind = F.when((F.col("a_start") == F.col("b_start")) & (F.col("a_end") == F.col("b_end")), "same").when((F.col("a_start") <= F.col("b_start")) & (F.col("a_end") >= F.col("b_end")), "contains").when((F.col("b_start") <= F.col("a_start")) & (F.col("b_end") >= F.col("a_end")), "inside").otherwise("partial")
    return out.select(link, "a", "b", days.alias("days"), kind.alias("relation"))
