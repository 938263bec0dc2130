"""JSON tables, manifests, sinks and reports on stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.catalog.files import AREAS, LINES, POINTS, K, _areas, _lines
from chronoloom.catalog.levels import INDEX
from chronoloom.catalog.reconcile import CAL, FP, ROLL, STATUS, DAYS, _days, _status
from chronoloom.functions import text as X
from chronoloom.functions import time as Z
from chronoloom.operators import geo
from chronoloom.operators.windows import newest
from chronoloom.plans import guideline as G
from chronoloom.plans import index_levels
from chronoloom.plans import reconcile as R
from chronoloom.plans import stores as S
from chronoloom.sources import files
from chronoloom.sources.fixtures import MEMBERS, OBS, members, observations, store_b, table
from chronoloom.sources.shared import scratch


def _new(spark):
    return scratch(spark, "store")


@register("s11_json_lines", f"WITH {OBS} SELECT seq, timeseries_id, observed_at, value, false AS malformed FROM obs WHERE seq % 50 <> 0 UNION ALL SELECT NULL, NULL, NULL, NULL, true FROM obs WHERE seq % 50 = 0")
def _(spark, d):
    """Compressed lines, some of them cut off, written and read."""
    j = F.to_json(F.struct("seq", "timeseries_id", "observed_at", "value"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    path = _new(spark)
    observations(spark, d).select(F.when(F.col("seq") % 50 == 0, F.substring(j, 1, 12)).otherwise(j).alias("value")).write.option("compression", "gzip").text(path)
    return files.read_json_lines(spark, path, "seq long, timeseries_id int, observed_at timestamp_ntz, value double")


MANIFESTS = f"{LINES}, f AS (SELECT day, connector, measure, min(ident) AS a, max(ident) AS b, count(*) AS n FROM li GROUP BY ALL)"


@register("s12_manifest_scan", f"WITH {MANIFESTS} SELECT day, connector, measure, a AS min_id, b AS max_id, n FROM f WHERE 25 BETWEEN a AND b")
def _(spark, d):
    """Manifests of days as JSON documents with lists of files; the files that may hold an id."""
    f = _lines(spark, d).groupBy(*K).agg(F.min("ident").alias("min_id"), F.max("ident").alias("max_id"), F.count("*").alias("n"))
    path = _new(spark)
    f.groupBy("day").agg(F.collect_list(F.struct("connector", "measure", "min_id", "max_id", "n")).alias("files")).write.json(path)
    return files.read_manifests(spark, path, "day date, files array<struct<connector string, measure string, min_id long, max_id long, n long>>").filter(F.lit(25).between(F.col("min_id"), F.col("max_id")))


@register("j21_range_join", f"WITH {MANIFESTS} SELECT s_suppkey AS ident, count(*) AS files, CAST(sum(n) AS BIGINT) AS n FROM f JOIN supplier ON s_suppkey BETWEEN a AND b WHERE s_suppkey % 7 = 0 GROUP BY ALL")
def _(spark, d):
    f = _lines(spark, d).groupBy(*K).agg(F.min("ident").alias("a"), F.max("ident").alias("b"), F.count("*").alias("n"))
    wanted = table(spark, d, "supplier").filter("s_suppkey % 7 = 0").select(F.col("s_suppkey").alias("ident"))
    return S.in_ranges(wanted, f, "ident", "a", "b").groupBy("ident").agg(F.count("*").alias("files"), F.sum("n").alias("n"))


_STORED = {c: files.INDEX_NAMES[c] for c in files.INDEX_NAMES if c != "computed_at"}
_AS = lambda names: ", ".join(f"{c} AS {_STORED[c]}" for c in names)


@register("s14_index_data_sink", f"WITH {INDEX} SELECT {_AS(files.INDEX_DATA)} FROM idx")
def _(spark, d):
    """Stored names, the columns that readers need, the reasons of missing levels among them."""
    path = _new(spark)
    files.write_index(index_levels.from_observations(observations(spark, d)), path, "data")
    return spark.read.parquet(path).drop("day_utc")


@register("s15_index_debug_sink", f"WITH {INDEX} SELECT {_AS(_STORED)}, TIMESTAMP '2024-02-03 04:05:06' AS computed_at_utc FROM (SELECT * REPLACE (round(daqi_input_value + 1e-9, 6) AS daqi_input_value, round(eaqi_input_value + 1e-9, 6) AS eaqi_input_value) FROM idx)")
def _(spark, d):
    """All columns, with the time of computation."""
    path = _new(spark)
    files.write_index(index_levels.from_observations(observations(spark, d)), path, "debug", "2024-02-03 04:05:06")
    back = spark.read.parquet(path).drop("day_utc")
    six = lambda c: F.round(F.col(c) + 1e-9, 6)
    return back.withColumns({c: six(c) for c in ("daqi_input_value_ugm3", "eaqi_input_value_ugm3")})


_SINK = lambda name, source, time, mean: f"SELECT '{name}' AS dataset, pollutant_code, timeseries_id, CAST({time} AS VARCHAR) AS period, round({mean} + 1e-9, 6) AS mean, has_enough_data FROM {source}"


@register("s16_guideline_sinks", f"WITH {STATUS}, {ROLL[len(DAYS) + 2:]}, {CAL[len(DAYS) + 2:]} {_SINK('daily', 'st', 'day', 'daily_mean')} UNION ALL {_SINK('rolling', 'ry', 'as_of', 'period_mean')} UNION ALL {_SINK('calendar', 'cy', 'year', 'period_mean')}")
def _(spark, d):
    """Three datasets under one root, each by measure; every row's period, mean and verdict are read back."""
    path, days = _new(spark), _days(spark, d)
    made = {"daily": (_status(spark, d), "day", "daily_mean"), "rolling": (G.rolling_year(days, 14, 10), "as_of", "period_mean"), "calendar": (G.calendar_year(days, "2024-01-25"), "year", "period_mean")}
    out = None
    for name, (rows, time, mean) in made.items():
        rows.write.partitionBy("pollutant_code").parquet(f"{path}/{name}")
        back = spark.read.schema(rows.schema).parquet(f"{path}/{name}").select(F.lit(name).alias("dataset"), "pollutant_code", "timeseries_id", F.col(time).cast("string").alias("period"), F.round(F.col(mean) + 1e-9, 6).alias("mean"), "has_enough_data")
        out = back if out is None else out.unionByName(back)
    return out


@register("s19_written_if_changed", f"""WITH {FP}, a AS (SELECT connector_id, CAST(hour AS DATE) AS day, sha256(string_agg(fingerprint, chr(10) ORDER BY hour)) AS f, CAST(sum(n) AS BIGINT) AS n FROM fa GROUP BY ALL), b AS (SELECT connector_id, CAST(hour AS DATE) AS day, sha256(string_agg(fingerprint, chr(10) ORDER BY hour)) AS f FROM fb GROUP BY ALL)
  SELECT a.connector_id, a.day, a.n, b.f IS NULL OR a.f <> b.f AS written FROM a LEFT JOIN b ON a.connector_id = b.connector_id AND a.day = b.day""")
def _(spark, d):
    """The second copy is stored; then the first is, but only its partitions whose content differs."""
    keys, path = ["connector_id", "day"], _new(spark)
    now, before = (o.withColumn("day", F.to_date("observed_at")) for o in (observations(spark, d), store_b(observations(spark, d))))
    day = lambda o: R.rolled_up(R.hour_buckets(o).withColumn("day", F.to_date("hour")), keys, ["hour"])
    before.withColumn("written", F.lit(False)).write.partitionBy(*keys).parquet(path)
    plan = files.write_plan(day(now).select(F.struct(*keys).alias("key"), F.col("fingerprint").alias("hash")), day(before).select(F.struct(*keys).alias("key"), F.col("fingerprint").alias("hash")))
    changed = plan.filter("action in ('write', 'replace')").select("key.*")
    files.write_partitions(now.withColumn("written", F.lit(True)).join(changed, keys, "left_semi"), path, keys)
    back = spark.read.parquet(path).groupBy(F.col("connector_id").cast("int").alias("connector_id"), F.col("day").cast("date").alias("day")).agg(F.count("*").alias("n"), F.bool_or("written").alias("written"))
    return back.join(now.select(*keys).distinct(), keys, "left_semi")


@register("d32_station_geography", f"WITH {AREAS}, {POINTS}, l AS (SELECT p.id, min(a.code) AS found FROM points p LEFT JOIN areas a ON p.lon BETWEEN a.x1 AND a.x2 AND p.lat BETWEEN a.y1 AND a.y2 GROUP BY ALL), s AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS stored FROM customer) SELECT id, stored, found, CASE WHEN stored IS NULL AND found IS NULL THEN 'unresolved' WHEN stored IS NULL THEN 'missing_stored_code' WHEN found IS NULL THEN 'outside_all_areas' WHEN stored = found THEN 'match' ELSE 'mismatch' END AS state FROM s JOIN l USING (id)")
def _(spark, d):
    c = F.col("c_custkey")
    points = table(spark, d, "customer").select(c.alias("id"), (c % 360 - 180 + F.lit(0.37)).alias("lon"), (c % 120 - 60 + F.lit(0.21)).alias("lat"), F.when(c % 3 != 0, F.col("c_nationkey")).alias("stored"))
    return S.geography_check(geo.located(points, _areas(spark, d)).withColumnRenamed("code", "found"), "stored", "found").select("id", "stored", "found", "state")


@register("d38_site_intervals", f"""WITH {OBS}, {MEMBERS}, br AS (SELECT 'S' || station_id % 3 AS site, station_id, timeseries_id, valid_from, valid_to FROM members), w AS (SELECT *, CASE WHEN valid_from <= lag(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY site ORDER BY valid_from, valid_to) THEN 1 ELSE 0 END AS o FROM br), g AS (SELECT site, count(*) AS intervals, count_if(valid_to < valid_from) AS inverted, string_agg(strftime(valid_from, '%Y-%m-%d') || ':' || station_id || ':' || timeseries_id, ',' ORDER BY valid_from, station_id, timeseries_id) AS listed, CAST(sum(o) AS BIGINT) AS "overlaps", count_if(valid_to IS NULL) AS opens FROM w GROUP BY ALL) SELECT site, intervals, inverted, listed, "overlaps", "overlaps" = 0 AND opens <= 1 AND inverted = 0 AS resolved FROM g""")
def _(spark, d):
    """Bridge rows that repeat are one identity."""
    m = members(observations(spark, d)).withColumn("site", F.concat(F.lit("S"), F.col("station_id") % 3))
    return S.site_intervals(m.unionByName(m), "site", ["station_id", "timeseries_id"])


@register("d39_missing_counts", f"WITH {LINES}, m AS (SELECT day, connector, measure, count(*) AS n FROM li GROUP BY ALL) SELECT connector, count(*) AS manifests, count_if(day(day) % 3 = 0) AS without_counts, CAST(coalesce(sum(n) FILTER (day(day) % 3 = 0), 0) AS BIGINT) AS rows_hint, round(count_if(day(day) % 3 <> 0) / count(*) + 1e-9, 4) AS share FROM m GROUP BY ALL")
def _(spark, d):
    m = _lines(spark, d).groupBy(*K).agg(F.count("*").alias("n"))
    counts = _lines(spark, d).filter(F.day("day") % 3 != 0).groupBy(*K, "ident").agg(F.count("*").alias("k"))
    return S.missing_counts(m, counts, K, "connector")


@register("d43_run_report", "WITH r AS (SELECT o_custkey AS job, CAST(o_orderdate AS DATE) AS started, CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 3 END AS ended FROM orders), g AS (SELECT job, max(ended) AS last_ended, count_if(ended IS NULL) AS in_flight, min(started) FILTER (ended IS NULL) AS oldest_open FROM r GROUP BY ALL) SELECT *, CASE WHEN date_diff('day', oldest_open, DATE '1998-09-01') > 1000 THEN 'stuck' WHEN last_ended IS NULL THEN 'never_finished' WHEN date_diff('day', last_ended, DATE '1998-09-01') > 200 THEN 'late' ELSE 'ok' END AS state FROM g")
def _(spark, d):
    o = table(spark, d, "orders")
    started = F.to_date("o_orderdate")
    runs = o.select(F.col("o_custkey").alias("job"), started.alias("started"), F.when((F.col("o_orderstatus") != "O") | (F.col("o_orderkey") % 3 == 0), F.date_add(started, 3)).alias("ended"))
    return S.run_report(runs, "job", "1998-09-01", 200, 1000)


@register("a31_label_candidates", "WITH u AS (SELECT p_type, 'u' || p_size % 5 AS unit, count(*) AS n FROM part GROUP BY ALL), h AS (SELECT p_type, string_agg(unit || ':' || n, ',' ORDER BY unit) AS units FROM u GROUP BY ALL), e AS (SELECT p_type, count(DISTINCT p_brand) AS files, count(DISTINCT p_size) AS sites, count(CASE WHEN p_size % 4 <> 0 THEN p_size END) AS filled FROM part GROUP BY ALL) SELECT e.p_type AS label, files, sites, filled, units FROM e JOIN h ON e.p_type = h.p_type")
def _(spark, d):
    size = F.col("p_size")
    p = table(spark, d, "part").select(F.col("p_type").alias("label"), "p_brand", "p_size", F.concat(F.lit("u"), size % 5).alias("unit"), F.when(size % 4 != 0, size).alias("v"))
    return S.label_candidates(p, "label", "p_brand", "p_size", "unit", "v")


@register("d35_code_sets", "WITH a AS (SELECT DISTINCT c_nationkey AS code FROM customer WHERE c_custkey % 10 = 1), b AS (SELECT DISTINCT n_nationkey AS code FROM nation WHERE n_nationkey % 6 <> 0) SELECT code, 'directory' AS \"where\" FROM a ANTI JOIN b USING (code) UNION ALL SELECT code, 'boundaries' FROM b ANTI JOIN a USING (code)")
def _(spark, d):
    a = table(spark, d, "customer").filter("c_custkey % 10 = 1").select(F.col("c_nationkey").alias("code"))
    return S.code_sets(a, table(spark, d, "nation").filter("n_nationkey % 6 <> 0").select(F.col("n_nationkey").alias("code")), "code")


@register("d18_guarded_validation", f"WITH {OBS}, h AS (SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, avg(value) AS v, count(*) AS n FROM obs GROUP BY ALL), s AS (SELECT timeseries_id, hour, v + CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END AS w, CASE WHEN timeseries_id % 10 = 0 THEN 'v1' ELSE 'v2' END AS version FROM h WHERE n % 5 <> 0), j AS (SELECT h.*, s.w, s.version FROM h LEFT JOIN s ON h.timeseries_id = s.timeseries_id AND h.hour = s.hour) SELECT CASE WHEN hour >= TIMESTAMP '2024-01-25 00:00:00' THEN 'mutable' WHEN version IS NULL THEN 'missing' WHEN version <> 'v2' THEN 'version_differs' WHEN abs(v - w) <= 0.001 THEN 'same' ELSE 'differs' END AS status, count(*) AS n FROM j GROUP BY ALL")
def _(spark, d):
    h = observations(spark, d).groupBy("timeseries_id", Z.hour_start("observed_at").alias("hour")).agg(F.avg("value").alias("v"), F.count("*").alias("n"))
    stored = h.filter("n % 5 <> 0").select("timeseries_id", "hour", (F.col("v") + (F.col("n") % 3 == 0).cast("int")).alias("v"), F.when(F.col("timeseries_id") % 10 == 0, "v1").otherwise("v2").alias("version"))
    return S.guarded_validation(h.withColumn("version", F.lit("v2")), stored, ["timeseries_id", "hour"], "v", F.col("hour") < F.lit("2024-01-25").cast("timestamp_ntz"), 0.001)


@register("j02_p08_public_snapshot", """WITH st AS (SELECT l_suppkey, l_partkey, arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber)) AS value FROM lineitem GROUP BY ALL)
  SELECT l_suppkey AS station_id, l_partkey AS phenomenon_id, value, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 9 END AS area_code, n_name AS network_name, r_name AS connector_name, p_type AS phenomenon, p_brand AS measure FROM st LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey
  WHERE s_suppkey % 4 <> 0 AND n_name IS NOT NULL AND n_nationkey % 5 <> 0""")
def _(spark, d):
    """D-29's joins: latest value of each series, then station, network, connector, phenomenon, measure; public rows stay."""
    latest = newest(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("station_id"), F.col("l_partkey").alias("phenomenon_id"), F.col("l_quantity").alias("value"), "l_shipdate", "l_orderkey", "l_linenumber"), ["station_id", "phenomenon_id"], ["l_shipdate", "l_orderkey", "l_linenumber"]).select("station_id", "phenomenon_id", "value")
    key = F.col("s_suppkey")
    station = table(spark, d, "supplier").select(key.alias("station_id"), F.col("s_nationkey").alias("network_id"), F.when(key % 4 != 0, key % 9).alias("area_code"))
    network = table(spark, d, "nation").select(F.col("n_nationkey").alias("network_id"), F.col("n_regionkey").alias("connector_id"), F.col("n_name").alias("network_name"), (F.col("n_nationkey") % 5 != 0).alias("is_public"))
    connector = table(spark, d, "region").select(F.col("r_regionkey").alias("connector_id"), F.col("r_name").alias("connector_name"))
    part = table(spark, d, "part")
    phenomenon = part.select(F.col("p_partkey").alias("phenomenon_id"), F.col("p_type").alias("phenomenon"), F.col("p_brand").alias("measure_id"))
    measure = part.select(F.col("p_brand").alias("measure_id")).distinct().withColumn("measure", F.col("measure_id"))
    out = S.public_snapshot(latest, station, network, connector, phenomenon, measure)
    return out.select("station_id", "phenomenon_id", "value", "area_code", "network_name", "connector_name", "phenomenon", "measure")


@register("f23_f24_f25_labels", "SELECT p_partkey, lower(p_type || ' 2 5 ' || replace(p_brand, '#', ' ')) AS label, 'µg/m³' AS unit, CASE WHEN p_partkey % 2 = 0 THEN 'SW1A' END AS outward FROM part")
def _(spark, d):
    """Tags, entities and punctuation go from labels; units and postcodes in their one form."""
    raw = F.concat(F.lit("&nbsp;"), F.col("p_type"), F.lit(" 2<sub>.</sub>5 &amp; "), F.col("p_brand"))
    code = F.when(F.col("p_partkey") % 2 == 0, " sw1a 2aa").otherwise("no code")
    return table(spark, d, "part").select("p_partkey", X.label(raw).alias("label"), X.unit(F.lit("ug m-3")).alias("unit"), X.postcode_outward(X.postcode(code)).alias("outward"))
