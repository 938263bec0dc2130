"""Summaries of partitions and their roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def part_summary(rows: DataFrame, keys: list[str], ident: str, ts: str) -> DataFrame:
    """Per partition: rows, bounds, rows of each id as a map; ids are counted before they are gathered."""
    per = rows.groupBy(*keys, ident).agg(F.count("*").alias("n"), F.min(ts).alias("a"), F.max(ts).alias("b"))
    return per.groupBy(*keys).agg(F.sum("n").alias("n"), F.min(ident).alias("min_id"), F.max(ident).alias("max_id"), F.min("a").alias("first"), F.max("b").alias("last"), F.count("*").alias("ids"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(ident, "n")))).alias("row_counts"))


def parent_summary(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser summaries from finer ones; maps are added up id by id."""
    flat = parts.select(*keys, F.explode("row_counts").alias("ident", "k")).groupBy(*keys, "ident").agg(F.sum("k").alias("k"))
    maps = flat.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ident", "k")))).alias("row_counts"))
    return parts.groupBy(*keys).agg(F.count("*").alias("children"), F.sum("n").alias("n"), F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), F.min("first").alias("first"), F.max("last").alias("last")).join(maps, keys)


def size_stats(files: DataFrame, keys: list[str]) -> DataFrame:
    """Files, bytes, bytes a row, smallest, largest and mean file."""
    return files.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.round(F.sum("bytes") / F.sum("n") + 1e-9, 3).alias("bytes_a_row"), F.min("bytes").alias("smallest"), F.max("bytes").alias("largest"), F.round(F.avg("bytes") + 1e-9, 3).alias("mean_bytes"))


def counts_by_bucket(rows: DataFrame, first: str, last: str, unit: str) -> DataFrame:
    """Per source and day or month: rows (0 where there are none), calendar days, mean a day, days with rows."""
    day = rows.groupBy("connector_id", F.to_date("observed_at").alias("day")).agg(F.count("*").alias("n"))
    grid = rows.select("connector_id").distinct().withColumn("day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    out = grid.join(day, ["connector_id", "day"], "left").groupBy("connector_id", F.to_date(F.date_trunc(unit, "day")).alias("bucket"))
    out = out.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("days"), F.count("n").alias("present_days"))
    return out.withColumn("a_day", F.round(F.col("n") / F.col("days") + 1e-9, 3))


def resolved_counts(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """The parent's count where it has one, else the sum of its children's."""
    c = children.groupBy(*keys).agg(F.sum("n").alias("c"))
    return parents.select(*keys, F.col("n").alias("p")).join(c, keys, "full_outer").select(*keys, F.coalesce("p", "c").alias("n"), F.col("p").isNull().alias("from_children"))
