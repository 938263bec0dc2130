"""Keyed unions with precedence, and differences of rows, sets and multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _tagged(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.withColumn("__p", F.lit(0)).unionByName(second.withColumn("__p", F.lit(1)), allowMissingColumns=True)


def prefer(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All keys of both; where both have a key, first's row. One row a key: a grouping with map-side choice."""
    both = _tagged(first, second)
    rest = [c for c in both.columns if c not in (*keys, "__p")]
    return both.groupBy(*keys).agg(F.min_by(F.struct(*rest), "__p").alias("__r")).select(*keys, "__r.*")


def merged_fields(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Where both have a key, each field is first's, or second's where that is null."""
    rest = [c for c in first.columns if c not in keys]
    return first.alias("f").join(second.alias("s"), keys, "full_outer").select(*keys, *[F.coalesce(F.col(f"f.{c}"), F.col(f"s.{c}")).alias(c) for c in rest])


def overlap(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the keys of second that first has too."""
    return second.select(*keys).distinct().join(first.select(*keys).distinct(), keys, "left_semi").agg(F.count("*").alias("overlap"))


def multiset_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_left, n_right, matched, missing, unexpected) for each distinct row."""
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    n = sides.groupBy(*keys).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    return n.withColumns({"matched": F.least("n_left", "n_right"), "missing": F.greatest(F.col("n_left") - F.col("n_right"), F.lit(0)), "unexpected": F.greatest(F.col("n_right") - F.col("n_left"), F.lit(0))})


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side alone, with the side."""
    return left.subtract(right).withColumn("only_in", F.lit("left")).unionByName(right.subtract(left).withColumn("only_in", F.lit("right")))
