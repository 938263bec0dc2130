"""Streams of messages and observations: sources, hourly windows, late rows, snapshots of latest values."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.plans import trees
from chronoloom.plans.latest import KEYS, latest_state, value_reason
from chronoloom.sources.commits import Versioned

STATE = "connector_id int, timeseries_id int, observed_at timestamp_ntz, value double, batch long, seq long"


def messages(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """Lines of JSON files as a stream, with the order of lines as seq."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def seeded(rows: DataFrame) -> DataFrame:
    """A first state from stored latest values: the latest row a key whose value is allowed. rows have pollutant_code."""
    good = rows.filter(value_reason(F.col("pollutant_code"), F.col("value")) == "eligible")
    return latest_state(good.withColumn("batch", F.lit(-1).cast("long"))).select(*[c.split(" ")[0] for c in STATE.split(", ")])


def hourly(stream: DataFrame, delay: str = "120 hours") -> DataFrame:
    """Hourly means of a stream of observations; hours may change for `delay`, and are final then."""
    at = F.col("observed_at").cast("timestamp")
    hours = stream.withColumn("at", at).withWatermark("at", delay).groupBy(F.window("at", "1 hour").alias("w"), *KEYS)
    return hours.agg(F.avg("value").alias("hourly_mean"), F.count("value").alias("sample_count")).select(*KEYS, F.col("w.start").cast("timestamp_ntz").alias("hour"), "hourly_mean", "sample_count")


def late(stream: DataFrame, start: str) -> tuple[DataFrame, DataFrame]:
    """Rows from start on, and the late ones before it, to be handled day by day."""
    old = F.col("observed_at") < F.lit(start).cast("timestamp_ntz")
    return stream.filter(~old), stream.filter(old).withColumn("day", F.to_date("observed_at"))


SNAPSHOT = ["pollutant_code"]


def snapshot_cursors(rows: DataFrame) -> DataFrame:
    """Per measure: rows, earliest and latest time, and where a reader goes on: the latest time and the largest series at it."""
    last = F.max(F.struct("observed_at", "timeseries_id"))
    out = rows.groupBy("pollutant_code").agg(F.count("*").alias("n"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"), last.alias("c"))
    return out.select("pollutant_code", "n", "first", "last", F.col("c.observed_at").alias("next_since"), F.col("c.timeseries_id").alias("next_since_id"))


def publish_snapshots(rows: DataFrame, table: Versioned) -> dict[str, int]:
    """Latest rows as JSON lines by measure, in order of time and series. A measure whose rows are as they were is not
    written again; the log's entry has count, hash and cursor of each (there are few). table has the keys SNAPSHOT and
    the form json."""
    columns = [c for c in rows.columns if c not in SNAPSHOT]
    hashes = trees.roots(rows, SNAPSHOT, trees.depth_for(rows, keys=SNAPSHOT), columns=columns).withColumnRenamed("fingerprint", "hash")
    told = snapshot_cursors(rows).join(hashes.select("pollutant_code", "hash"), "pollutant_code")
    shown = told.select("pollutant_code", "n", "hash", *[F.col(c).cast("string").alias(c) for c in ("first", "last", "next_since", "next_since_id")])
    order = [*SNAPSHOT, "observed_at", "timeseries_id"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)  # a large measure is several files, in order
    return table.publish(ordered, hashes.select("pollutant_code", "hash"), {"snapshots": {r["pollutant_code"]: r.asDict() for r in shown.collect()}})


def drained(stream: DataFrame, root: str, mode: str = "append") -> DataFrame:
    """What a stream's query gives when its input has been read to the end. In append mode each batch adds what has
    become final; a repeated batch replaces its own folder."""
    spark, path = stream.sparkSession, f"{root}/chronoloom-stream-{uuid.uuid4().hex}"
    write = lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/out/batch={batch if mode == 'append' else 0}")
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(*[f"{path}/out/batch=*"])
