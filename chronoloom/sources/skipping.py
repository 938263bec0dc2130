"""Reads that ask an index first and open only files that may hold what is wanted.

The index has a row for each file and series: rows, first and last time, and the values of the file's partition. It is
built by one pass over the history (or brought up to date for new files alone) and is itself a table by day, so that a
question about some days reads those days' rows. Manifests are the same by file, as JSON documents.

A question is a table of (series, start, end); it meets the index in a join, and the distinct files that come out, which
Spark's own listing would hold on the driver as well, are what is read. Filters still hold in the files that are opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.sources.files import partition_value, read_manifests

INDEX = "file string, day_utc date, connector_id int, pollutant_code string, timeseries_id int, n long, first timestamp_ntz, last timestamp_ntz"
MANIFEST = "day_utc date, files array<struct<file string, connector_id int, pollutant_code string, min_id int, max_id int, n long, first timestamp_ntz, last timestamp_ntz>>"


def file_index(rows: DataFrame) -> DataFrame:
    """rows with file (see read_history) to INDEX: one row a file and series."""
    out = rows.groupBy("file", "timeseries_id").agg(F.count("*").alias("n"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))
    path = {"day_utc": "date", "connector_id": "int", "pollutant_code": "string"}
    return out.select("file", *[partition_value(c).cast(t).alias(c) for c, t in path.items()], "timeseries_id", "n", "first", "last")


def write_index(index: DataFrame, root: str) -> None:
    """The index as a table by day; days that it has are replaced."""
    index.repartition("day_utc").sortWithinPartitions("day_utc", "timeseries_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day_utc").parquet(root)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(root)


def refreshed(index: DataFrame, rows: DataFrame) -> DataFrame:
    """The index for files as they are now: what it says of files that are still there, and new files by a read of those
    alone. rows: the history with file."""
    here = rows.select("file").distinct()
    new = rows.join(index.select("file").distinct(), "file", "left_anti")
    return index.join(here, "file", "left_semi").select(*[c.split(" ")[0] for c in INDEX.split(", ")]).unionByName(file_index(new))


def asked(spark: SparkSession, series: list[int], start: str, end: str) -> DataFrame:
    """A question for some series in [start, end)."""
    rows = spark.createDataFrame([(s,) for s in series], "timeseries_id int")
    return rows.select("timeseries_id", F.lit(start).cast("timestamp_ntz").alias("start"), F.lit(end).cast("timestamp_ntz").alias("end"))


def files_to_read(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(file): files of the index with a row of a wanted series between its first and last time. A question's days prune
    the index's folders."""
    span = wanted.agg(F.to_date(F.min("start")).alias("a"), F.to_date(F.max("end")).alias("b")).first()
    if span["a"] is None:
        return index.select("file").limit(0)
    days = index.filter(F.col("day_utc").between(F.lit(span["a"]), F.lit(span["b"])))
    met = days.join(wanted, "timeseries_id").filter((F.col("last") >= F.col("start")) & (F.col("first") < F.col("end")))
    return met.select("file").distinct()


def files_by_manifest(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """(file): files whose manifests name a range of ids and times that a wanted series may lie in. Ids meet ranges in
    tiles (see in_ranges)."""
    from chronoloom.plans.stores import in_ranges

    listed = read_manifests(spark, root, MANIFEST)
    met = in_ranges(wanted, listed, "timeseries_id", "min_id", "max_id")
    return met.filter((F.col("last") >= F.col("start")) & (F.col("first") < F.col("end"))).select("file").distinct()


def write_manifests(index: DataFrame, root: str) -> None:
    """A JSON document a day, with a range of ids and of times for each file."""
    per = index.groupBy("day_utc", "file", "connector_id", "pollutant_code").agg(F.min("timeseries_id").alias("min_id"), F.max("timeseries_id").alias("max_id"), F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    listed = F.sort_array(F.collect_list(F.struct("file", "connector_id", "pollutant_code", "min_id", "max_id", "n", "first", "last")))
    per.groupBy("day_utc").agg(listed.alias("files")).repartition("day_utc").write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(root)


def read_files(spark: SparkSession, root: str, files: DataFrame, schema) -> DataFrame:
    """The rows of the files, with the values of their partitions; of no file, none. Nothing else is listed or opened."""
    names = [r["file"] for r in files.collect()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*names)


def wanted_rows(spark: SparkSession, root: str, files: DataFrame, wanted: DataFrame, schema) -> DataFrame:
    """Rows of the wanted series and times, from the files alone; a row counts once however often it is asked for."""
    rows = read_files(spark, root, files, schema)
    asked_for = wanted.select(F.col("timeseries_id").alias("__id"), F.col("start").alias("__start"), F.col("end").alias("__end"))
    hit = (F.col("timeseries_id") == F.col("__id")) & (F.col("observed_at") >= F.col("__start")) & (F.col("observed_at") < F.col("__end"))
    few = [r[0] for r in wanted.select("timeseries_id").distinct().limit(101).collect()]
    if len(few) <= 100:  # a filter that reaches the files' row groups
        rows = rows.filter(F.col("timeseries_id").isin(few))
    return rows.join(asked_for, hit, "left_semi")
