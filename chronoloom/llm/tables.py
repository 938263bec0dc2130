"""Intermediate tables in the folder that all executors share, and connected components over edges."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.sources.shared import files_of, scratch


def release(spark: SparkSession) -> None:
    """Shuffle files of plans that nothing refers to any more are removed, for which Spark waits for a collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, *done: DataFrame) -> DataFrame:
    """df written as Parquet and read again: its lineage ends here, and a lost executor costs no recomputation beyond
    it. Files of the earlier stored tables in `done`, which nothing reads after this, go then; all others go when the
    application ends. Shuffle files of earlier steps go first."""
    spark = df.sparkSession
    release(spark)
    path = scratch(spark, "llm")
    df.write.option("compression", "zstd").parquet(path)
    dropped(*done)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*done: DataFrame) -> None:
    """Removes the files of stored tables."""
    for df in done:
        files, at = files_of(df.sparkSession, df.stored_at)
        files.delete(at, True)


def _hanging(edge: DataFrame) -> bool:
    """Whether all edges (a > b) hang on smallest nodes: no a has two edges, or one from which another hangs."""
    ends = edge.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edge.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b: long) to (id, component): each id that an edge has, and the smallest id that it reaches.

    Alternating large-star and small-star steps: every node tells its larger neighbours, then its smaller ones, of the
    smallest node around it, until all hang on their smallest node. Each step is a grouping with map-side minimum and a
    join; the rounds grow with the logarithm of a component's size. A null or looping edge links nothing.
    """
    edge = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _hanging(edge):
        both = edge.unionByName(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edge = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), edge)
    roots = edge.select(F.col("b").alias("id")).distinct()
    return edge.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("id")))
