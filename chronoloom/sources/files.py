"""Reads and writes of partitioned history, manifests and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ["day_utc", "connector_id", "pollutant_code"]
#: Accepted column sets of observation files. Fixed values.
VARIANTS = (
    {"timeseries_id", "observed_at", "value"},
    {"timeseries_id", "observed_at", "value", "status"},
    {"timeseries_id", "observed_at", "value", "verification_status"},
)


def read_history(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All files under root, partition columns from the path, and file. With a schema no footer is read to find one;
    without, columns are the union of the files'."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(root).withColumn("file", F.col("_metadata.file_path"))


def partition_value(name: str, file: str = "file"):
    v = F.regexp_extract(file, name + r"=([^/]+)", 1)
    return F.when(v != "", v)


def read_variants(parts: list[DataFrame]) -> DataFrame:
    """The union of parts whose columns are one of the accepted sets; others are an error."""
    out = None
    for df in parts:
        own = {c for c in df.columns if c not in PARTITIONS and c != "file"}
        if own not in VARIANTS:
            raise ValueError(f"unknown column set: {sorted(own)}")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_history(rows: DataFrame, root: str, clustered: bool = True, max_records: int = 500_000) -> None:
    """One partition for each day, source and measure; rows in order of series and time; only partitions that rows have
    are replaced."""
    rows = rows.withColumn("day_utc", F.to_date("observed_at"))
    if clustered:
        # A day's large measure is spread by series; each task writes the partitions it holds in order.
        rows = rows.repartition(*PARTITIONS, F.col("timeseries_id") % 16).sortWithinPartitions(*PARTITIONS, "timeseries_id", "observed_at")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", max_records).partitionBy(*PARTITIONS).parquet(root)


def write_report(rows: DataFrame, path: str, sep: str = ",") -> None:
    rows.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON, compressed or not, under a schema; a line that is none gives nulls and malformed."""
    rows = spark.read.schema(f"{schema}, __bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").json(path)
    good = F.col("__bad").isNull()
    return rows.select(*[F.when(good, F.col(c)).alias(c) for c in rows.columns if c != "__bad"], (~good).alias("malformed"))


def read_manifests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, each with an array `files`, to a row for each file with the document's other fields."""
    return spark.read.schema(schema).json(path).select("*", F.explode("files").alias("__f")).select("*", "__f.*").drop("files", "__f")


#: Own name -> name in a stored index row, in order: all columns, and those that the data profile keeps. Fixed values.
INDEX_NAMES = {
    "connector_id": "connector_id", "station_id": "station_id", "timeseries_id": "timeseries_id", "pollutant_code": "pollutant_code", "hour": "timestamp_hour_utc",
    "daqi_input_value": "daqi_input_value_ugm3", "daqi_averaging": "daqi_input_averaging_code", "daqi_level": "daqi_index_level", "daqi_count": "daqi_source_observation_count",
    "daqi_required": "daqi_required_observation_count", "daqi_status": "daqi_calculation_status", "daqi_reason": "daqi_missing_reason",
    "eaqi_input_value": "eaqi_input_value_ugm3", "eaqi_averaging": "eaqi_input_averaging_code", "eaqi_level": "eaqi_index_level", "eaqi_count": "eaqi_source_observation_count",
    "eaqi_required": "eaqi_required_observation_count", "eaqi_status": "eaqi_calculation_status", "eaqi_reason": "eaqi_missing_reason",
    "hourly_sample_count": "hourly_sample_count", "version": "algorithm_version", "computed_at": "computed_at_utc",
}
INDEX_DATA = ("connector_id", "station_id", "timeseries_id", "pollutant_code", "hour", "daqi_level", "eaqi_level", "daqi_status", "daqi_reason", "eaqi_status", "eaqi_reason")


def write_index(rows: DataFrame, root: str, profile: str, computed_at: str | None = None) -> None:
    """Index rows by day and measure under their stored names: the columns of INDEX_DATA (profile data), or all of them
    with the time of computation (debug)."""
    names = INDEX_DATA if profile == "data" else tuple(INDEX_NAMES)
    made = rows.withColumn("computed_at", F.lit(computed_at).cast("timestamp_ntz"))
    kept = made.select("hour", *[F.col(c).alias(INDEX_NAMES[c]) for c in names])
    kept.withColumn("day_utc", F.to_date("hour")).drop("hour").write.mode("overwrite").option("compression", "zstd").partitionBy("day_utc", "pollutant_code").parquet(root)


def write_partitions(rows: DataFrame, root: str, keys: list[str]) -> None:
    """Replaces those partitions under root that rows have, and no other."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)


def read_wide_csv(spark: SparkSession, path: str, measures: dict[str, str], ids: list[str], time: str) -> DataFrame:
    """A semicolon CSV with one column a measure, to rows (ids, time, measure, value, skipped: why a row cannot be used)."""
    raw = spark.read.option("header", True).option("sep", ";").csv(path)
    long = raw.unpivot([*ids, time], [c for c in measures if c in raw.columns], "field", "text")
    name = F.coalesce(*[F.when(F.col("field") == k, F.lit(v)) for k, v in measures.items()])
    value = F.trim("text").try_cast("double")
    at = F.try_to_timestamp(F.col(time)).cast("timestamp_ntz")
    why = F.when(F.col("text").isNull() | (F.trim("text") == ""), "empty").when(value.isNull(), "not_a_number").when(at.isNull(), "bad_time")
    return long.select(*ids, at.alias("observed_at"), name.alias("measure"), value.alias("value"), why.alias("skipped"))


def read_triplets(lines: DataFrame, header: list[str]) -> DataFrame:
    """Lines `date,time,(value,status,unit)*` to (line, date, time, measure, value, status, unit); header names measures."""
    cells = F.split("value", ",", -1)
    each = F.transform(F.sequence(F.lit(0), F.lit(len(header) - 1)), lambda i: F.struct(F.element_at(F.array(*map(F.lit, header)), i + 1).alias("measure"), F.get(cells, 2 + 3 * i).alias("value"), F.get(cells, 3 + 3 * i).alias("status"), F.get(cells, 4 + 3 * i).alias("unit")))
    return lines.select(F.get(cells, F.lit(0)).alias("date"), F.get(cells, F.lit(1)).alias("time"), F.explode(each).alias("t")).select("date", "time", "t.*").filter("value <> ''")


def file_stats(rows: DataFrame) -> DataFrame:
    """(file, timeseries_id, n, first, last) for skipping files before a read."""
    return rows.groupBy("file", "timeseries_id").agg(F.count("*").alias("n"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))


def stale_files(on_disk: DataFrame, listed: DataFrame) -> DataFrame:
    """Files that no manifest lists. An empty list of manifests is an error, not a licence to delete all."""
    if listed.isEmpty():
        raise ValueError("no file is listed: refusing to call all files stale")
    return on_disk.join(listed, "file", "left_anti")


def write_plan(new: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """(keys, action): skip, write, replace or delete, from content hashes (key, hash) of both sides."""
    both = new.select("key", F.col("hash").alias("n")).join(existing.select("key", F.col("hash").alias("e")), "key", "full_outer")
    n, e = F.col("n"), F.col("e")
    action = F.when(n.isNull(), "delete").when(e.isNull(), "write").when((n == e) & F.lit(not force), "skip").otherwise("replace")
    return both.select("key", action.alias("action"))


def after_token(rows: DataFrame, series: int, ts: str, n: int) -> DataFrame:
    """The next n rows after the token (series, time), in that order."""
    later = (F.col("timeseries_id") > series) | ((F.col("timeseries_id") == series) & (F.col("observed_at") > F.lit(ts).cast("timestamp_ntz")))
    return rows.filter(later).orderBy("timeseries_id", "observed_at").limit(n)
