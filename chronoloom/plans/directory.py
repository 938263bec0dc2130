"""A directory of postcodes with places: exact shards, suggestion shards, a dictionary of areas and towns, prefix hints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.operators.ranks import dense_ids
from chronoloom.operators.windows import newest


def judged(rows: DataFrame) -> DataFrame:
    """rows (postcode, lat, lon: text, terminated, place: order of rows, ...) with code, lat and lon as numbers, and skipped:
    terminated, invalid_code, invalid_coordinate, or null for a row that counts."""
    live = F.trim(F.coalesce(F.col("terminated"), F.lit(""))) == ""
    out = rows.withColumns({"code": X.postcode(F.col("postcode")), "lat": X.coordinate(F.col("lat"), -90, 90), "lon": X.coordinate(F.col("lon"), -180, 180)})
    why = F.when(~live, "terminated").when(F.col("code").isNull(), "invalid_code").when(F.col("lat").isNull() | F.col("lon").isNull(), "invalid_coordinate")
    return out.withColumn("skipped", why)


def directory(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judged rows with area and town to (entries, dictionary): one entry a code, the last row's, with area_town_id and the
    shard that holds it; the dictionary numbers distinct pairs in their order, from 1."""
    last = newest(rows.filter("skipped is null").select("code", "lat", "lon", "pcon", "la", "area", "town", "place"), ["code"], ["place"]).drop("place")
    pairs = dense_ids(last.filter("area is not null or town is not null"), ["area", "town"], "area_town_id")
    same = last["area"].eqNullSafe(pairs["area"]) & last["town"].eqNullSafe(pairs["town"])
    entries = last.join(pairs, same, "left").select("code", X.postcode_display(F.col("code")).alias("shown"), "lat", "lon", "pcon", "la", "area_town_id", X.postcode_shard(F.col("code")).alias("shard"))
    return entries, pairs


def prefix_samples(codes: DataFrame, most: int, levels: tuple[int, ...], longest: int = 7) -> DataFrame:
    """(prefix, code): of the codes (code) that begin with a prefix, the `most` smallest, for prefixes of the lengths in
    levels. A trie from its leaves up: each length takes its samples from those of the next, so that a group never has
    more than a letter's or digit's samples each, however many codes a short prefix has."""
    w = Window.partitionBy("prefix").orderBy("code")
    known = codes.select("code").distinct()
    samples, out = None, []
    for size in range(longest, 0, -1):
        here = known.filter(F.length("code") == size).select(F.col("code").alias("prefix"), "code")
        if samples is not None:
            here = here.unionByName(samples.select(F.substring("prefix", 1, size).alias("prefix"), "code"))
        samples = here.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= most).drop("rn")
        if size in levels:
            out.append(samples)
    return reduce(DataFrame.unionByName, out)


def write_directory(rows: DataFrame, root: str, most: int = 8, levels: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Writes shards/shard=*, suggest/shard=*, dictionary and hints under root, and gives one row of what there is."""
    spark = rows.sparkSession
    told = judged(rows)
    entries, pairs = directory(told)
    entries.select("shard", "code", "lat", "lon", "pcon", "la", "area_town_id").repartition("shard").sortWithinPartitions("shard", "code").write.mode("overwrite").partitionBy("shard").json(f"{root}/shards")
    kept = spark.read.schema("code string, lat double, lon double, pcon string, la string, area_town_id long, shard string").json(f"{root}/shards")
    suggested = kept.select("shard", "code", X.postcode_display(F.col("code")).alias("shown"), "area_town_id", "pcon", "la")
    suggested.repartition("shard").sortWithinPartitions("shard", "code").write.mode("overwrite").partitionBy("shard").json(f"{root}/suggest")
    pairs.write.mode("overwrite").json(f"{root}/dictionary")
    hints = prefix_samples(kept, most, levels).join(suggested.drop("shard"), "code")
    hints.withColumn("size", F.length("prefix")).write.mode("overwrite").partitionBy("size").json(f"{root}/hints")
    count = lambda why: F.count_if(F.coalesce(F.col("skipped") == why, F.lit(False))).alias(f"{why}_skipped")
    skipped = told.agg(F.count("*").alias("rows"), count("terminated"), count("invalid_code"), count("invalid_coordinate"))
    there = kept.agg(F.count("*").alias("codes"), F.count_distinct("shard").alias("shards"), F.count_distinct("area_town_id").alias("pairs"), F.count_if(F.col("area_town_id").isNull()).alias("without_pair"))
    return skipped.join(there, F.lit(True))
