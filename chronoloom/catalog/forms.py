"""Forms of source files and of single values."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.functions import text as X
from chronoloom.functions import time as Z
from chronoloom.sources import files
from chronoloom.sources.fixtures import OBS, observations, table
from chronoloom.sources.shared import scratch


@register("s08_schema_variants", f"WITH {OBS} SELECT seq % 3 AS kind, timeseries_id, observed_at, value, CASE WHEN seq % 3 = 1 THEN 'P' END AS status, CASE WHEN seq % 3 = 2 THEN 'R' END AS verification_status FROM obs")
def _(spark, d):
    o = observations(spark, d)
    part = lambda k: o.filter(F.col("seq") % 3 == k).select("timeseries_id", "observed_at", "value")
    out = files.read_variants([part(0), part(1).withColumn("status", F.lit("P")), part(2).withColumn("verification_status", F.lit("R"))])
    kind = F.when(F.col("status").isNotNull(), 1).when(F.col("verification_status").isNotNull(), 2).otherwise(0)
    return out.select(kind.cast("long").alias("kind"), "timeseries_id", "observed_at", "value", "status", "verification_status")


@register("s09_wide_csv", """SELECT o_orderkey AS site, o_orderdate AS observed_at, 'no2' AS measure, CAST(o_custkey AS DOUBLE) AS value, NULL AS skipped FROM orders UNION ALL
  SELECT o_orderkey, o_orderdate, 'pm10', CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_custkey % 7 AS DOUBLE) END, CASE WHEN o_orderkey % 3 = 0 THEN 'empty' WHEN o_orderkey % 3 = 1 THEN 'not_a_number' END FROM orders""")
def _(spark, d):
    """An archive with a column for each measure, some cells empty or no numbers."""
    o, path = table(spark, d, "orders"), scratch(spark, "csv")
    k = F.col("o_orderkey")
    cell = F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, "n/a").otherwise((F.col("o_custkey") % 7).cast("string"))
    o.select(k.alias("site"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time"), F.col("o_custkey").alias("NO2"), cell.alias("PM10")).write.option("header", True).option("sep", ";").csv(path)
    out = files.read_wide_csv(spark, path, {"NO2": "no2", "PM10": "pm10"}, ["site"], "time")
    return out.withColumn("site", F.col("site").cast("long"))


@register("s10_triplet_csv", """SELECT o_orderkey AS site, 'no2' AS measure, CAST(o_custkey AS VARCHAR) AS value, 'V' AS status, 'ugm-3' AS unit FROM orders UNION ALL SELECT o_orderkey, 'pm10', CAST(o_custkey % 9 AS VARCHAR), 'P', 'mgm-3' FROM orders WHERE o_orderkey % 4 <> 0""")
def _(spark, d):
    """Lines of value, status, unit for each measure; a measure without a value has no row."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey")
    second = F.when(F.col("o_orderkey") % 4 == 0, ",,").otherwise(F.concat((c % 9).cast("string"), F.lit(",P,mgm-3")))
    lines = table(spark, d, "orders").select(F.concat_ws(",", k, F.lit("01:00"), c.cast("string"), F.lit("V"), F.lit("ugm-3"), second).alias("value"))
    return files.read_triplets(lines, ["no2", "pm10"]).select(F.col("date").cast("long").alias("site"), "measure", "value", "status", "unit")


@register("f09_f10_source_times", """SELECT o_orderkey, date_trunc('day', o_orderdate) + CASE WHEN o_orderkey % 4 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 1 HOUR * (o_orderkey % 24) END AS at, o_orderdate AS plain FROM orders""")
def _(spark, d):
    """Dates in two forms, 24:00 as the next day's start; times without a zone are UTC."""
    k = F.col("o_orderkey")
    date = F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    time = F.when(k % 4 == 0, "24:00").otherwise(F.format_string("%02d:00", k % 24))
    plain = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(k % 2 == 0, "Z").otherwise(""))
    return table(spark, d, "orders").select("o_orderkey", Z.utc_from_source(date, time).alias("at"), Z.utc_without_zone(plain).alias("plain"))


@register("f21_f35_labels_and_status", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'pm' || p_size END AS shown, CASE WHEN p_partkey % 3 = 0 THEN 'P' WHEN p_partkey % 3 = 1 THEN 'R' END AS status FROM part""")
def _(spark, d):
    k = F.col("p_partkey")
    first = F.when(k % 2 == 0, F.col("p_name")).otherwise("")
    raw = F.when(k % 3 == 0, " p").when(k % 3 == 1, "R ").otherwise("")
    return table(spark, d, "part").select("p_partkey", X.phenomenon_label(first, F.concat(F.lit("http://a/b:pm"), F.col("p_size"))).alias("shown"), X.verification(raw).alias("status"))


@register("f33_float_bits", f"WITH {OBS} SELECT seq, value, 16 AS digits FROM obs")
def _(spark, d):
    """A double's bits as text, and back again."""
    text = observations(spark, d).select("seq", X.float_bits(F.col("value")).alias("t"))
    return text.select("seq", X.bits_float(F.col("t")).alias("value"), F.length("t").alias("digits"))


@register("f32_canonical_rows", f"""WITH {OBS} SELECT seq, '[' || connector_id || ',' || station_id || ',' || timeseries_id || ',"' || pollutant_code || '","' || strftime(date_trunc('millisecond', observed_at), '%Y-%m-%dT%H:%M:%S.%g') || 'Z",' AS head, CASE WHEN seq % 2 = 0 THEN ',"P"]' ELSE ',null]' END AS tail FROM obs""")
def _(spark, d):
    """What stands before and after the value's bits; f32_canonical_texts has whole rows."""
    at = F.date_trunc("millisecond", "observed_at").cast("timestamp_ntz")
    row = X.canonical_row(F.col("connector_id"), F.col("station_id"), F.col("timeseries_id"), F.col("pollutant_code"), at, F.col("value"), X.verification(F.when(F.col("seq") % 2 == 0, "p")))
    made = observations(spark, d).select("seq", row.alias("r"))
    return made.select("seq", F.regexp_extract("r", r'^(.*?)"[0-9a-f]{16}"', 1).alias("head"), F.regexp_extract("r", r'"[0-9a-f]{16}"(.*)$', 1).alias("tail"))
