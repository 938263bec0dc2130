"""Moving observations to a layout by day, source and measure, in one plan with a check before the switch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.plans import trees
from chronoloom.sources.commits import Versioned
from chronoloom.sources.files import PARTITIONS


def bound(rows: DataFrame, bindings: DataFrame) -> DataFrame:
    """rows (connector_id, timeseries_id, observed_at, value) with what their series belongs to and problem: no_binding,
    other_connector, no_measure, no_time, or null for what can be moved."""
    b = bindings.select("timeseries_id", F.col("connector_id").alias("__connector"), "station_id", "pollutant_code", F.lit(True).alias("__known"))
    out = rows.join(b, "timeseries_id", "left")
    problem = (
        F.when(F.col("__known").isNull(), "no_binding").when(F.col("__connector") != F.col("connector_id"), "other_connector")
        .when(F.col("pollutant_code").isNull(), "no_measure").when(F.col("observed_at").isNull(), "no_time")
    )
    return out.withColumns({"problem": problem, "day_utc": F.to_date("observed_at")}).drop("__connector", "__known")


def numbered_parts(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Adds part, from 0: rows of a partition in order of series and time, `most` in each. A row's place is what the series
    before its own hold, from counts, and its place in its own series; so no partition is sorted as one."""
    size = rows.groupBy(*keys, "timeseries_id").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*keys).orderBy("timeseries_id")
    size = size.withColumn("__before", F.sum("__n").over(w) - F.col("__n")).drop("__n")
    own = F.row_number().over(Window.partitionBy(*keys, "timeseries_id").orderBy("observed_at", "value"))
    placed = rows.withColumn("__own", own).join(size, [*keys, "timeseries_id"])
    return placed.withColumn("part", F.floor((F.col("__before") + F.col("__own") - 1) / most)).drop("__own", "__before")


class CountsDiffer(RuntimeError):
    """What was written is not what was read; the old version stays."""


def migrate(rows: DataFrame, bindings: DataFrame, target: Versioned, most: int = 500_000, allowed: tuple[str, ...] = ()) -> dict:
    """Binds rows, splits them by day, source and measure, numbers parts, and publishes what changed, once rows of every
    partition and series have been counted in the files. Rows that cannot be moved end it, unless their problem is in
    `allowed`; they are counted in the log's entry either way. Returns the counts by problem and action."""
    told = bound(rows, bindings)
    problems = {r["problem"]: r["n"] for r in told.groupBy("problem").agg(F.count("*").alias("n")).collect() if r["problem"]}
    if left := {p: n for p, n in problems.items() if p not in allowed}:
        raise ValueError(f"rows that cannot be moved: {left}")
    kept = numbered_parts(told.filter("problem is null").select(*PARTITIONS, "station_id", "timeseries_id", "observed_at", "value"), PARTITIONS, most)
    hashes = trees.roots(kept, PARTITIONS, trees.depth_for(kept, keys=PARTITIONS)).withColumnRenamed("fingerprint", "hash")

    def verify(written: DataFrame, meant: DataFrame) -> None:
        per = lambda df: df.groupBy(*PARTITIONS, "timeseries_id", "part").count()
        wrong = per(written).exceptAll(per(meant)).unionByName(per(meant).exceptAll(per(written)))
        if not wrong.isEmpty():
            raise CountsDiffer("rows in the files differ from rows that were read")

    actions = target.publish(kept.sortWithinPartitions(*PARTITIONS, "timeseries_id", "observed_at"), hashes, {"problems": problems}, before_switch=verify)
    return {"problems": problems, "actions": actions}
