"""Scalar functions, manifests, geography and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.functions import text as X
from chronoloom.functions import time as Z
from chronoloom.operators import geo
from chronoloom.operators import manifests as M
from chronoloom.operators.ranks import dense_ids
from chronoloom.plans import reconcile as R
from chronoloom.sources import files as S
from chronoloom.sources.fixtures import OBS, observations, table

LINES = "li AS (SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS connector, l_linestatus AS measure, l_suppkey AS ident, CAST(l_shipdate AS TIMESTAMP) AS ts, l_orderkey, l_linenumber FROM lineitem)"


def _lines(spark, d):
    return table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("connector"), F.col("l_linestatus").alias("measure"), F.col("l_suppkey").alias("ident"), F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), "l_orderkey", "l_linenumber")


K = ["day", "connector", "measure"]


@register("a11_a12_part_summary", f"WITH {LINES}, p AS (SELECT day, connector, measure, ident, count(*) AS n FROM li GROUP BY ALL) SELECT day, connector, measure, CAST(sum(n) AS BIGINT) AS n, min(ident) AS min_id, max(ident) AS max_id, min(CAST(day AS TIMESTAMP)) AS first, max(CAST(day AS TIMESTAMP)) AS last, count(*) AS ids, string_agg(ident || ':' || n, ',' ORDER BY ident) AS listed FROM p GROUP BY ALL")
def _(spark, d):
    out = M.part_summary(_lines(spark, d), K, "ident", "ts")
    return out.withColumn("listed", F.array_join(F.transform(F.map_entries("row_counts"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")).drop("row_counts")


@register("a13_parent_summary", f"WITH {LINES}, p AS (SELECT day, connector, measure, count(*) AS n, min(ident) AS a, max(ident) AS b FROM li GROUP BY ALL) SELECT day, connector, count(*) AS children, CAST(sum(n) AS BIGINT) AS n, min(a) AS min_id, max(b) AS max_id, CAST(sum(n) AS BIGINT) AS mapped FROM p GROUP BY ALL")
def _(spark, d):
    out = M.parent_summary(M.part_summary(_lines(spark, d), K, "ident", "ts"), ["day", "connector"])
    return out.withColumn("mapped", F.aggregate(F.map_values("row_counts"), F.lit(0).cast("long"), lambda a, x: a + x)).drop("row_counts", "first", "last")


@register("a12_size_stats", f"WITH {LINES}, f AS (SELECT day, connector, measure, l_linenumber, count(*) AS n, CAST(sum(l_orderkey % 1000) AS BIGINT) AS bytes FROM li GROUP BY ALL) SELECT connector, measure, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, round(sum(bytes) / sum(n) + 1e-9, 3) AS bytes_a_row, min(bytes) AS smallest, max(bytes) AS largest, round(avg(bytes) + 1e-9, 3) AS mean_bytes FROM f GROUP BY ALL")
def _(spark, d):
    f = _lines(spark, d).groupBy(*K, "l_linenumber").agg(F.count("*").alias("n"), F.sum(F.col("l_orderkey") % 1000).alias("bytes"))
    return M.size_stats(f, ["connector", "measure"])


@register("a15_f44_range_shards", """WITH u AS (SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus) AS h FROM orders), s AS (SELECT CAST(floor(o_orderkey / 1000) * 1000 AS BIGINT) AS shard, count(*) AS n, sha256(string_agg(h, chr(10) ORDER BY h)) AS fingerprint FROM u GROUP BY ALL) SELECT * FROM s""")
def _(spark, d):
    u = table(spark, d, "orders").select(X.range_start(F.col("o_orderkey")).cast("long").alias("shard"), F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"), 256).alias("h"))
    return u.groupBy("shard").agg(F.count("*").alias("n"), R.digest(F.array_sort(F.collect_list("h"))).alias("fingerprint"))


def _counts(unit):
    return f"""WITH {OBS}, dd AS (SELECT connector_id, CAST(observed_at AS DATE) AS day, count(*) AS n FROM obs GROUP BY ALL), g AS (SELECT DISTINCT connector_id, CAST(unnest(generate_series(TIMESTAMP '2023-12-20', TIMESTAMP '2024-02-10', INTERVAL 1 DAY)) AS DATE) AS day FROM obs)
  SELECT g.connector_id, CAST(date_trunc('{unit}', g.day) AS DATE) AS bucket, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, count(*) AS days, count(n) AS present_days, round(coalesce(sum(n), 0) / count(*) + 1e-9, 3) AS a_day FROM g LEFT JOIN dd ON g.connector_id = dd.connector_id AND g.day = dd.day GROUP BY ALL"""


@register("a17_day_counts", _counts("day"))
def _(spark, d):
    return M.counts_by_bucket(observations(spark, d), "2023-12-20", "2024-02-10", "day")


@register("a17_month_counts", _counts("month"))
def _(spark, d):
    """D-31's coverage by day is present_days of the day grain."""
    return M.counts_by_bucket(observations(spark, d), "2023-12-20", "2024-02-10", "month")


@register("a18_resolved_counts", f"WITH {LINES}, p AS (SELECT day, connector, count(*) AS n FROM li WHERE day(day) % 2 = 0 GROUP BY ALL), c AS (SELECT day, connector, count(*) AS n FROM li GROUP BY ALL) SELECT c.day, c.connector, coalesce(p.n, c.n) AS n, p.n IS NULL AS from_children FROM c LEFT JOIN p USING (day, connector)")
def _(spark, d):
    li = _lines(spark, d)
    child = li.groupBy(*K).agg(F.count("*").alias("n"))
    return M.resolved_counts(li.filter(F.day("day") % 2 == 0).groupBy("day", "connector").agg(F.count("*").alias("n")), child, ["day", "connector"])


@register("s20_write_plan", "SELECT coalesce(a.o_custkey, b.o_custkey) AS key, CASE WHEN a.h IS NULL THEN 'delete' WHEN b.h IS NULL THEN 'write' WHEN a.h = b.h THEN 'skip' ELSE 'replace' END AS action FROM (SELECT o_custkey, count(*) AS h FROM orders WHERE o_custkey % 7 <> 0 GROUP BY ALL) a FULL JOIN (SELECT o_custkey, count(*) + max(CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END) AS h FROM orders WHERE o_custkey % 11 <> 0 GROUP BY o_custkey) b ON a.o_custkey = b.o_custkey")
def _(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_custkey")
    one = lambda df, extra: df.groupBy(k.alias("key")).agg((F.count("*")).alias("hash")).withColumn("hash", F.col("hash") + extra)
    return S.write_plan(one(o.filter(k % 7 != 0), F.lit(0)), one(o.filter(k % 11 != 0), F.when(F.col("key") % 5 == 0, 1).otherwise(0)))


@register("s23_after_token", f"WITH {OBS} SELECT timeseries_id, observed_at, seq FROM obs WHERE timeseries_id > 20 OR (timeseries_id = 20 AND observed_at > TIMESTAMP '2024-01-20') ORDER BY timeseries_id, observed_at LIMIT 300")
def _(spark, d):
    return S.after_token(observations(spark, d), 20, "2024-01-20", 300).select("timeseries_id", "observed_at", "seq")


@register("p14_drop_candidates", f"WITH {OBS}, dd AS (SELECT DISTINCT CAST(observed_at AS DATE) AS day FROM obs) SELECT day FROM dd WHERE day + 1 <= DATE '2024-01-11'")
def _(spark, d):
    return observations(spark, d).select(F.to_date("observed_at").alias("day")).distinct().filter(F.date_add("day", 1) <= F.lit("2024-01-11").cast("date"))


@register("d14_gated_retention", f"WITH {OBS}, dd AS (SELECT CAST(observed_at AS DATE) AS day, count(*) AS n FROM obs GROUP BY ALL), g AS (SELECT day, day(day) % 3 = 0 AS committed FROM dd WHERE day(day) % 4 <> 0) SELECT dd.day, n, CASE WHEN n = 0 OR coalesce(committed, false) THEN 'drop' WHEN committed IS NULL THEN 'keep_no_gate' ELSE 'keep_not_committed' END AS decision FROM dd LEFT JOIN g USING (day)")
def _(spark, d):
    """D-13 too: a gate without evidence keeps the day."""
    dd = observations(spark, d).groupBy(F.to_date("observed_at").alias("day")).agg(F.count("*").alias("n"))
    g = dd.filter(F.day("day") % 4 != 0).select("day", (F.day("day") % 3 == 0).alias("committed"))
    c = F.col("committed")
    decision = F.when((F.col("n") == 0) | F.coalesce(c, F.lit(False)), "drop").when(c.isNull(), "keep_no_gate").otherwise("keep_not_committed")
    return dd.join(g, "day", "left").select("day", "n", decision.alias("decision"))


@register("p12_f14_local_days", f"WITH {OBS} SELECT CAST(observed_at AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris' AS DATE) AS day, count(*) AS n FROM obs GROUP BY ALL")
def _(spark, d):
    return observations(spark, d).groupBy(Z.local_day("observed_at", "Europe/Paris").alias("day")).agg(F.count("*").alias("n"))


@register("f13_f16_day_and_hour_lists", f"WITH {OBS}, b AS (SELECT timeseries_id, min(observed_at) AS a, max(observed_at) AS z FROM obs GROUP BY ALL) SELECT timeseries_id, CAST(date_diff('day', CAST(a AS DATE), CAST(z AS DATE)) - 1 AS INTEGER) AS covered, CAST(date_diff('hour', date_trunc('hour', a), date_trunc('hour', z)) AS INTEGER) AS endpoints, CAST(date_diff('day', CAST(a AS DATE), CAST(z AS DATE)) + 1 AS INTEGER) AS days FROM b")
def _(spark, d):
    b = observations(spark, d).groupBy("timeseries_id").agg(F.min("observed_at").alias("a"), F.max("observed_at").alias("z"))
    a, z = F.col("a"), F.col("z")
    return b.select("timeseries_id", F.size(Z.covered_days(a, z)).alias("covered"), F.size(Z.hour_endpoints(a, z)).alias("endpoints"), Z.days_inclusive(F.to_date(a), F.to_date(z)).alias("days"))


@register("f18_f12_batches", f"WITH {OBS}, b AS (SELECT timeseries_id, date_trunc('hour', min(observed_at)) AS a, date_trunc('hour', max(observed_at)) AS z FROM obs GROUP BY ALL), s AS (SELECT timeseries_id, unnest(generate_series(a, z - INTERVAL 1 HOUR, INTERVAL 48 HOURS)) AS start, z FROM b) SELECT timeseries_id, start, least(start + INTERVAL 48 HOURS, z) AS \"end\" FROM s")
def _(spark, d):
    b = observations(spark, d).groupBy("timeseries_id").agg(Z.hour_start(F.min("observed_at")).alias("a"), Z.hour_start(F.max("observed_at")).alias("z"))
    s = b.select("timeseries_id", F.explode(F.sequence("a", F.col("z") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 48 HOURS"))).alias("start"), "z")
    return s.select("timeseries_id", "start", F.least(F.col("start") + F.expr("INTERVAL 48 HOURS"), F.col("z")).alias("end"))


@register("t08_days_newest_first", f"WITH {OBS} SELECT DISTINCT CAST(observed_at AS DATE) AS day FROM obs ORDER BY day DESC LIMIT 10")
def _(spark, d):
    """T-09 too: the last days of a set."""
    return observations(spark, d).select(F.to_date("observed_at").alias("day")).distinct().orderBy(F.desc("day")).limit(10)


@register("f01_f02_measure_codes", """WITH p AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN ' PM2.5 ' WHEN 1 THEN 'iPM10' WHEN 2 THEN 'NO2' WHEN 3 THEN 'Ozone' WHEN 4 THEN 'pm_2' WHEN 5 THEN 'Nitrogen dioxide' ELSE p_brand END AS raw FROM part)
  SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'pm25' WHEN 1 THEN 'pm10' WHEN 2 THEN 'no2' WHEN 3 THEN 'o3' WHEN 4 THEN 'pm25' WHEN 5 THEN 'no2' END AS code FROM p""")
def _(spark, d):
    k = F.col("p_partkey")
    raw = F.when(k % 7 == 0, " PM2.5 ").when(k % 7 == 1, "iPM10").when(k % 7 == 2, "NO2").when(k % 7 == 3, "Ozone").when(k % 7 == 4, "pm_2").when(k % 7 == 5, "Nitrogen dioxide").otherwise(F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", X.measure_code(raw).alias("code"))


@register("f07_f26_numbers", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE round(c_acctbal, 6) END AS n, CASE WHEN c_custkey % 3 <> 0 AND c_acctbal BETWEEN -90 AND 90 THEN round(c_acctbal, 6) END AS lat, CASE WHEN c_custkey > 0 THEN c_custkey END AS id FROM customer")
def _(spark, d):
    t = F.when(F.col("c_custkey") % 3 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
    return table(spark, d, "customer").select("c_custkey", F.round(X.number(t), 6).alias("n"), X.coordinate(t, -90, 90).alias("lat"), X.positive_int(F.col("c_custkey").cast("string")).alias("id"))


@register("f34_canonical_numbers", f"WITH {OBS} SELECT seq, CASE WHEN seq % 5 = 0 THEN '0.0' ELSE CAST(value AS VARCHAR) END AS t FROM obs")
def _(spark, d):
    v = F.when(F.col("seq") % 5 == 0, F.lit(-0.0)).otherwise(F.col("value"))
    return observations(spark, d).select("seq", X.canonical_number(v).alias("t"))


@register("f19_s02_day_of_path", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _(spark, d):
    path = F.concat(F.lit("/h/day_utc="), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/connector_id=1/part-0.parquet"))
    return table(spark, d, "orders").select("o_orderkey", path.alias("file")).select("o_orderkey", S.partition_value("day_utc").alias("day"))


@register("f27_reference_parts", "SELECT p_partkey, 'site:' || p_brand AS station, p_type AS measure FROM part")
def _(spark, d):
    a, b = X.reference_parts(F.concat_ws(":", F.lit("site"), "p_brand", "p_type"))
    return table(spark, d, "part").select("p_partkey", a.alias("station"), b.alias("measure"))


@register("f41_cache_class", f"WITH {OBS} SELECT CASE WHEN observed_at <= TIMESTAMP '2024-01-25' - INTERVAL 120 HOURS THEN 'immutable' ELSE 'mutable' END AS class, count(*) AS n FROM obs GROUP BY ALL")
def _(spark, d):
    """X-13's horizon."""
    return observations(spark, d).groupBy(X.cache_class(F.col("observed_at"), "2024-01-25").alias("class")).agg(F.count("*").alias("n"))


@register("f43_dictionary", "WITH p AS (SELECT DISTINCT p_brand, p_type FROM part) SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) AS INTEGER) AS id FROM p")
def _(spark, d):
    """Numbered by ranges, in no single task."""
    return dense_ids(table(spark, d, "part"), ["p_brand", "p_type"]).withColumn("id", F.col("id").cast("int"))


@register("t04_prefix_samples", "SELECT prefix, code FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY code) AS rn FROM (SELECT DISTINCT substr(p_name, 1, 2) AS prefix, p_name AS code FROM part)) WHERE rn <= 5")
def _(spark, d):
    from pyspark.sql import Window

    c = table(spark, d, "part").select(F.substring("p_name", 1, 2).alias("prefix"), F.col("p_name").alias("code")).distinct()
    return c.withColumn("rn", F.row_number().over(Window.partitionBy("prefix").orderBy("code"))).filter("rn <= 5").drop("rn")


@register("t05_ranked_search", "WITH c AS (SELECT DISTINCT p_brand AS outward, p_name AS code FROM part) SELECT code, rank FROM (SELECT code, CASE WHEN outward = 'Brand#1' THEN 0 WHEN starts_with(outward, 'Brand#1') THEN 1 WHEN starts_with('Brand#1', outward) THEN 2 ELSE 3 END AS rank, outward FROM c) ORDER BY rank, code, outward LIMIT 20")
def _(spark, d):
    c = table(spark, d, "part").select(F.col("p_brand").alias("outward"), F.col("p_name").alias("code")).distinct()
    q, o = F.lit("Brand#1"), F.col("outward")
    rank = F.when(o == q, 0).when(F.startswith(o, q), 1).when(F.startswith(q, o), 2).otherwise(3)
    return c.withColumn("rank", rank).orderBy("rank", "code", "outward").limit(20).select("code", "rank")


@register("j20_a31_label_choice", "WITH a AS (SELECT p_type AS label, count(DISTINCT p_brand) AS n, min(p_brand) AS code FROM part GROUP BY ALL) SELECT label, CASE WHEN n = 1 THEN code END AS code, CASE WHEN n = 1 THEN 'ok' ELSE 'ambiguous' END AS state FROM a")
def _(spark, d):
    a = table(spark, d, "part").groupBy(X.label(F.col("p_type")).alias("l"), F.col("p_type").alias("label")).agg(F.count_distinct("p_brand").alias("n"), F.min("p_brand").alias("code"))
    return a.select("label", F.when(F.col("n") == 1, F.col("code")).alias("code"), F.when(F.col("n") == 1, "ok").otherwise("ambiguous").alias("state"))


@register("j21_s12_range_index", f"WITH {LINES}, f AS (SELECT day, connector, measure, min(ident) AS a, max(ident) AS b FROM li GROUP BY ALL) SELECT connector, count(*) AS files FROM f WHERE 25 BETWEEN a AND b GROUP BY ALL")
def _(spark, d):
    f = _lines(spark, d).groupBy(*K).agg(F.min("ident").alias("a"), F.max("ident").alias("b"))
    return f.filter(F.lit(25).between(F.col("a"), F.col("b"))).groupBy("connector").agg(F.count("*").alias("files"))


AREAS = "areas AS (SELECT n_nationkey AS code, CAST(n_nationkey * 14 - 180 AS DOUBLE) AS x1, CAST(n_nationkey % 5 * 24 - 60 AS DOUBLE) AS y1, CAST(n_nationkey * 14 - 162 AS DOUBLE) AS x2, CAST(n_nationkey % 5 * 24 - 33 AS DOUBLE) AS y2 FROM nation)"
POINTS = "points AS (SELECT c_custkey AS id, c_custkey % 360 - 180 + 0.37 AS lon, c_custkey % 120 - 60 + 0.21 AS lat FROM customer)"


def _areas(spark, d):
    n = F.col("n_nationkey")
    box = table(spark, d, "nation").select(n.alias("code"), (n * 14 - 180).cast("double").alias("x1"), (n % 5 * 24 - 60).cast("double").alias("y1"), (n * 14 - 162).cast("double").alias("x2"), (n % 5 * 24 - 33).cast("double").alias("y2"))
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("x1", "y1"), corner("x2", "y1"), corner("x2", "y2"), corner("x1", "y2"), corner("x1", "y1"))
    return box.withColumn("polygons", F.array(F.array(ring)))


@register("j18_located_points", f"WITH {AREAS}, {POINTS} SELECT p.id, CAST(p.lon AS DOUBLE) AS lon, CAST(p.lat AS DOUBLE) AS lat, min(a.code) AS code FROM points p LEFT JOIN areas a ON p.lon BETWEEN a.x1 AND a.x2 AND p.lat BETWEEN a.y1 AND a.y2 GROUP BY ALL")
def _(spark, d):
    """F-28..F-31 and D-33 under it: tiles, boxes, rings."""
    c = F.col("c_custkey")
    points = table(spark, d, "customer").select(c.alias("id"), (c % 360 - 180 + F.lit(0.37)).alias("lon"), (c % 120 - 60 + F.lit(0.21)).alias("lat"))
    return geo.located(points, _areas(spark, d))


@register("j19_neighbours", f"WITH {AREAS} SELECT a.code, string_agg(CAST(b.code AS VARCHAR), ',' ORDER BY b.code) AS neighbours FROM areas a JOIN areas b ON a.code <> b.code AND a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2 GROUP BY ALL")
def _(spark, d):
    return geo.neighbours(_areas(spark, d))


@register("a33_covering_box", f"WITH {AREAS} SELECT min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM areas")
def _(spark, d):
    return geo.covering_box(geo.boxes(_areas(spark, d).select("code", "polygons")))
