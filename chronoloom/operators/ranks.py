"""Dense numbers over a whole table without one task that sees it all."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.sources.shared import scratch

PLACE = 33  # bits of a row's place in its partition, in monotonically_increasing_id


def dense_ids(rows: DataFrame, columns: list[str], name: str = "id", first: int = 1) -> DataFrame:
    """The distinct values of columns, numbered in their order (nulls first): dealt into ranges, numbered within each, and
    moved on by what the ranges before hold. The numbered ranges are a table, as a second sampling could cut them
    elsewhere; what the driver sees is a count a range."""
    spark = rows.sparkSession
    path = scratch(spark, "ranks")
    placed = rows.select(*columns).distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed.withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    back = spark.read.parquet(path)
    part, place = F.shiftright("__at", PLACE), F.col("__at").bitwiseAND((1 << PLACE) - 1)
    counts = sorted(back.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    start = dict(zip([r["part"] for r in counts], accumulate([r["n"] for r in counts], initial=first), strict=False))
    moved = spark.createDataFrame(list(start.items()), "__part long, __start long")
    return back.withColumn("__part", part).join(F.broadcast(moved), "__part").select(*columns, (place + F.col("__start")).alias(name))
