"""Queries on decision tables, projections and the remaining joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.catalog.levels import INDEX
from chronoloom.functions import text as X
from chronoloom.functions.time import hour_start
from chronoloom.plans import decisions as D
from chronoloom.plans import index_levels
from chronoloom.plans import reconcile as R
from chronoloom.plans.latest import matrix_measure
from chronoloom.sources.fixtures import BINDINGS, OBS, STORE_B, bindings, observations, store_b, table


@register("p09_p10_profile", f"WITH {INDEX} SELECT timeseries_id, hour, daqi_level, eaqi_level, CAST(NULL AS VARCHAR) AS note FROM idx WHERE hourly_sample_count IS NULL OR daqi_level >= 5")
def _(spark, d):
    """Rows of filled hours stay only with a result; absent columns are null."""
    out = index_levels.from_observations(observations(spark, d)).filter("hourly_sample_count is null or daqi_level >= 5")
    wanted = ["timeseries_id", "hour", "daqi_level", "eaqi_level", "note"]
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in wanted])


@register("p11_compact_rows", f"WITH {OBS} SELECT seq, [CAST(timeseries_id AS VARCHAR), pollutant_code, CAST(connector_id AS VARCHAR)] AS cells FROM obs")
def _(spark, d):
    return observations(spark, d).select("seq", F.array(F.col("timeseries_id").cast("string"), "pollutant_code", F.col("connector_id").cast("string")).alias("cells"))


@register("p13_recent_days", "SELECT o_orderkey, CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-10' AND DATE '1995-06-16' AS recent FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", D.in_recent_window(F.to_date("o_orderdate"), "1995-06-17").alias("recent"))


@register("f17_window_bounds", "SELECT o_orderkey, greatest(o_orderdate, least(o_orderdate + INTERVAL 200 DAYS, TIMESTAMP '1995-06-17') - INTERVAL 90 DAYS) AS start, least(o_orderdate + INTERVAL 200 DAYS, TIMESTAMP '1995-06-17') AS \"end\" FROM orders")
def _(spark, d):
    o = F.col("o_orderdate").cast("timestamp_ntz")
    a, b = D.window_bounds("1995-06-17", o, o + F.expr("INTERVAL 200 DAYS"), 90)
    return table(spark, d, "orders").select("o_orderkey", a.alias("start"), b.alias("end"))


@register("p15_d25_coverage", """WITH r AS (SELECT o_orderkey AS id, o_orderkey % 2 AS a, o_orderkey % 3 AS b, o_orderkey % 5 AS c, o_orderkey % 7 = 0 AS l, o_orderkey % 11 AS s, o_orderkey % 4 AS w FROM orders),
  q AS (SELECT id, concat_ws(';', CASE WHEN a > 0 THEN 'missing_day_manifest' END, CASE WHEN b > 0 THEN 'missing_connector_manifest' END, CASE WHEN c > 0 THEN 'missing_parquet' END, CASE WHEN l THEN 'limited_by_limit' END, CASE WHEN s > 0 THEN 'timeseries_index_skipped_day' END, CASE WHEN w > 0 THEN 'timeseries_index_warning' END) AS reasons FROM r)
  SELECT id, reasons, reasons = '' AS complete, CASE WHEN reasons = '' THEN 'complete' ELSE 'partial' END AS state FROM q""")
def _(spark, d):
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").select(k.alias("id"), (k % 2).alias("missing_days"), (k % 3).alias("missing_sources"), (k % 5).alias("missing_files"), (k % 7 == 0).alias("limited"), (k % 11).alias("skipped_days"), (k % 4).alias("warnings"))
    return D.coverage(r).select("id", "reasons", "complete", "state")


ELIGIBLE = f"""WITH {OBS}, r AS (SELECT timeseries_id, min(connector_id) AS source, min(station_id) AS station, min(pollutant_code) AS code, count(DISTINCT station_id) AS stations, count(DISTINCT pollutant_code) AS measures, min(observed_at) AS f FROM obs GROUP BY ALL),
  s AS (SELECT timeseries_id AS sid, source AS ss, CASE WHEN timeseries_id <> 31 THEN station END AS st, CASE WHEN timeseries_id <> 20 THEN f END AS fv, CASE WHEN timeseries_id = 30 THEN TIMESTAMP '2024-01-03' END AS en FROM r WHERE timeseries_id <> 51),
  p AS (SELECT sid AS pid, ss AS ps, (SELECT code FROM r WHERE timeseries_id = sid) AS pc FROM s WHERE sid <> 41)
  SELECT timeseries_id, CASE WHEN sid IS NULL THEN 'missing_timeseries' WHEN ss <> 1 THEN 'connector_mismatch' WHEN st IS NULL THEN 'station_id_null' WHEN pid IS NULL THEN 'missing_phenomenon' WHEN ps <> ss THEN 'phenomenon_connector_mismatch' WHEN pc IS NULL THEN 'missing_observed_property'
    WHEN lower(pc) NOT IN ('no2', 'pm25', 'pm10') THEN 'pollutant_not_requested' WHEN fv IS NULL THEN 'first_value_at_null' WHEN fv > TIMESTAMP '2024-01-11' THEN 'first_value_at_after_day_end' WHEN en < TIMESTAMP '2024-01-10' THEN 'ended_before_day_start' ELSE 'eligible' END AS eligibility,
    nullif(concat_ws(', ', CASE WHEN source <> ss THEN 'stored_connector_differs' END, CASE WHEN station IS DISTINCT FROM st THEN 'stored_station_differs' END, CASE WHEN code IS DISTINCT FROM pc THEN 'stored_pollutant_differs' END, CASE WHEN stations <> 1 THEN 'multiple_stations_for_id' END, CASE WHEN measures <> 1 THEN 'multiple_pollutants_for_id' END), '') AS warning
  FROM r LEFT JOIN s ON timeseries_id = sid LEFT JOIN p ON sid = pid"""


@register("p17_p18_j03_j04_mapping_eligibility", ELIGIBLE)
def _(spark, d):
    r = observations(spark, d).groupBy("timeseries_id").agg(F.min("connector_id").alias("stored_source"), F.min("station_id").alias("stored_station"), F.min("pollutant_code").alias("stored_code"), F.count_distinct("station_id").alias("stations"), F.count_distinct("pollutant_code").alias("measures"), F.min("observed_at").alias("f"))
    t = F.col("timeseries_id")
    s = r.filter(t != 51).select(t.alias("series_id"), F.col("stored_source").alias("series_source"), F.when(t != 31, F.col("stored_station")).alias("series_station"), F.when(t != 20, F.col("f")).alias("first_value_at"), F.when(t == 30, F.lit("2024-01-03").cast("timestamp_ntz")).alias("ended_at"))
    p = r.filter(~t.isin(51, 41)).select(t.alias("phenomenon_id"), F.col("stored_source").alias("phenomenon_source"), F.col("stored_code").alias("property_code"))
    joined = r.join(s, t == F.col("series_id"), "left").join(p, F.col("series_id") == F.col("phenomenon_id"), "left")
    return D.mapping_eligibility(joined, 1, "2024-01-10").select("timeseries_id", "eligibility", "warning")


@register("d21_gap_status", f"""WITH {INDEX}, o AS (SELECT timeseries_id, pollutant_code, CAST(observed_at AS DATE) AS day, count(*) AS n, list_distinct(list(hour(observed_at))) AS hs FROM obs GROUP BY ALL), i AS (SELECT timeseries_id, CAST(hour AS DATE) AS day, count(*) AS n, list_distinct(list(hour(hour))) AS hs FROM idx WHERE day(hour) % 3 <> 0 AND hour(hour) <> 5 GROUP BY ALL),
  j AS (SELECT o.timeseries_id, o.day, pollutant_code, o.n AS orows, coalesce(i.n, 0) AS irows, o.hs AS oh, coalesce(i.hs, []) AS ih, day(o.day) % 4 <> 0 AS oi, day(o.day) % 5 <> 0 AS ii, CASE WHEN day(o.day) % 7 = 0 THEN 1 END AS listed FROM o LEFT JOIN i ON o.timeseries_id = i.timeseries_id AND o.day = i.day),
  q AS (SELECT *, CASE WHEN pollutant_code IN ('no2', 'pm25', 'pm10') THEN oh ELSE [] END AS e FROM j),
  s AS (SELECT timeseries_id, day, concat_ws(';', CASE WHEN len(e) > 0 AND len(ih) = 0 THEN 'missing_aqi_data' END, CASE WHEN irows > 0 AND NOT ii THEN 'missing_aqi_index' END, CASE WHEN orows > 0 AND NOT oi THEN 'missing_obs_index' END, CASE WHEN len(list_filter(e, lambda x: NOT list_contains(ih, x))) > 0 THEN 'missing_expected_aqi_hours' END, CASE WHEN irows > 0 AND listed < irows THEN 'stale_or_partial_aqi_index' END) AS t FROM q)
  SELECT timeseries_id, day, CASE WHEN t = '' THEN 'ok' ELSE t END AS status FROM s""")
def _(spark, d):
    obs = observations(spark, d)
    o = obs.groupBy("timeseries_id", "pollutant_code", F.to_date("observed_at").alias("day")).agg(F.count("*").alias("obs_rows"), F.collect_set(F.hour("observed_at")).alias("obs_hours"))
    i = index_levels.from_observations(obs).filter((F.day("hour") % 3 != 0) & (F.hour("hour") != 5)).groupBy("timeseries_id", F.to_date("hour").alias("day")).agg(F.count("*").alias("index_rows"), F.collect_set(F.hour("hour")).alias("index_hours"))
    n = F.day("day")
    j = o.join(i, ["timeseries_id", "day"], "left").withColumns({"index_rows": F.coalesce("index_rows", F.lit(0)), "index_hours": F.coalesce("index_hours", F.array().cast("array<int>")), "has_obs_index": n % 4 != 0, "has_index": n % 5 != 0, "listed_rows": F.when(n % 7 == 0, 1)})
    return D.gap_status(j).select("timeseries_id", "day", "status")


_GAPS = ["connector_manifest_missing", "day_manifest_stale", "index_missing", "observation_content_hash_missing", "pollutant_dir_missing", "row_count_mismatch", "other"]


@register("d22_repair_decisions", f"""WITH g AS (SELECT o_orderkey AS id, list_element([{", ".join(f"'{g}'" for g in _GAPS)}], CAST(o_orderkey % 7 + 1 AS INTEGER)) AS gap, CASE WHEN o_orderkey % 2 = 0 THEN 'pm25' ELSE 'o3' END AS m, o_orderkey % 3 = 0 AS u, o_orderkey % 5 = 0 AS h FROM orders)
  SELECT id, CASE WHEN gap = 'pollutant_dir_missing' AND m <> 'pm25' THEN 'unclassified' WHEN gap = 'connector_manifest_missing' THEN 'connector_manifest_repair' WHEN gap = 'day_manifest_stale' THEN 'day_manifest_repair' WHEN gap = 'index_missing' THEN 'index_repair' WHEN gap LIKE 'observation_content_hash_%' AND h THEN 'pollutant_manifest_repair'
    WHEN gap IN ('pollutant_dir_missing', 'row_count_mismatch') AND u THEN 'source_mapping_issue' WHEN gap IN ('pollutant_dir_missing', 'row_count_mismatch') THEN 'data_repair' ELSE 'unclassified' END AS repair FROM g""")
def _(spark, d):
    k = F.col("o_orderkey")
    gap = F.element_at(F.array(*map(F.lit, _GAPS)), (k % 7 + 1).cast("int"))
    return table(spark, d, "orders").select(k.alias("id"), gap.alias("gap"), F.when(k % 2 == 0, "pm25").otherwise("o3").alias("m"), (k % 3 == 0).alias("u"), (k % 5 == 0).alias("h")).select("id", D.repair_kind(F.col("gap"), F.col("m"), F.col("u"), F.col("h")).alias("repair"))


@register("d18_sampled_validation", f"""WITH {OBS}, {STORE_B}, a AS (SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, max(value) AS hi FROM obs GROUP BY ALL), b AS (SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, max(value) AS hi FROM store_b GROUP BY ALL)
  SELECT a.timeseries_id, a.hour FROM a JOIN b USING (timeseries_id, hour) WHERE abs(a.hi - b.hi) > 0.1 AND list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST(a.timeseries_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda x, y: (x * 31 + y) % 4294967296) % 100 < 60""")
def _(spark, d):
    f = lambda o: o.groupBy("timeseries_id", hour_start("observed_at").alias("hour")).agg(F.max("value").alias("hi"))
    a = observations(spark, d)
    diff = R.tolerance_difference(f(a), f(store_b(a)), ["timeseries_id", "hour"], ["hi"], 0.1).filter("kind = 'mismatch'")
    return R.sampled(diff.withColumn("t", F.col("timeseries_id").cast("string")), "t", 60).select("timeseries_id", "hour")


@register("w13_latest_label", "SELECT o_custkey, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS label, CAST(min(o_orderdate) AS DATE) AS oldest FROM orders GROUP BY ALL")
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("label"), F.to_date(F.min("o_orderdate")).alias("oldest"))


@register("j09_parameters", f"WITH {OBS}, p AS (SELECT 50.0 AS least, 2 AS source) SELECT seq, value FROM obs, p WHERE value >= least AND connector_id = source")
def _(spark, d):
    """A row of parameters is literals of the plan."""
    p = {"least": 50.0, "source": 2}
    return observations(spark, d).filter((F.col("value") >= p["least"]) & (F.col("connector_id") == p["source"])).select("seq", "value")


@register("j10_missing_rows", f"WITH {OBS}, {STORE_B} SELECT DISTINCT timeseries_id, observed_at FROM store_b b WHERE observed_at >= TIMESTAMP '2024-01-05' AND NOT EXISTS (SELECT 1 FROM obs o WHERE o.timeseries_id = b.timeseries_id AND o.observed_at = b.observed_at)")
def _(spark, d):
    o, k = observations(spark, d), ["timeseries_id", "observed_at"]
    return store_b(o).filter("observed_at >= timestamp_ntz'2024-01-05'").select(k).distinct().join(o.select(k), k, "left_anti")


@register("j11_unlisted_files", "SELECT DISTINCT o_custkey AS file FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, d):
    from chronoloom.sources.files import stale_files

    o = table(spark, d, "orders").select(F.col("o_custkey").alias("file"), "o_orderstatus")
    return stale_files(o.select("file").distinct(), o.filter("o_orderstatus = 'F'").select("file"))


@register("j01_unbound_counts", f"WITH {OBS}, {BINDINGS} SELECT o.timeseries_id, count(*) AS n FROM obs o ANTI JOIN bindings b ON o.timeseries_id = b.timeseries_id GROUP BY ALL")
def _(spark, d):
    o = observations(spark, d)
    return o.join(bindings(o).select("timeseries_id"), "timeseries_id", "left_anti").groupBy("timeseries_id").agg(F.count("*").alias("n"))


@register("a34_json_batches", f"WITH {OBS}, c AS (SELECT connector_id, date_trunc('hour', observed_at) AS hour, CAST(floor((row_number() OVER (PARTITION BY connector_id, date_trunc('hour', observed_at) ORDER BY observed_at, seq) - 1) / 5) AS BIGINT) AS chunk, seq FROM obs) SELECT connector_id, hour, chunk, count(*) AS rows, min(seq) AS lo, max(seq) AS hi FROM c GROUP BY ALL")
def _(spark, d):
    """Chunks are numbered within an hour of a source; each is one JSON array, whose length and bounds are read back."""
    from chronoloom.functions.time import hour_start
    from chronoloom.operators.windows import numbered_chunks

    keys = ["connector_id", "hour"]
    c = numbered_chunks(observations(spark, d).withColumn("hour", hour_start("observed_at")), keys, ["observed_at", "seq"], 5)
    packed = c.groupBy(*keys, "chunk").agg(F.to_json(F.collect_list(F.struct("seq", "value"))).alias("payload"))
    back = F.from_json("payload", "array<struct<seq long, value double>>")
    return packed.select(*keys, "chunk", back.alias("p")).select(*keys, "chunk", F.size("p").cast("long").alias("rows"), F.array_min(F.transform("p", lambda x: x["seq"])).alias("lo"), F.array_max(F.transform("p", lambda x: x["seq"])).alias("hi"))


@register("f20_f22_display_names", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE n_name || ' - r' || n_nationkey END AS shown, coalesce(nullif(n_name, 'NATION_7'), 'ref' || n_nationkey) AS station FROM nation")
def _(spark, d):
    n, k = F.col("n_name"), F.col("n_nationkey").cast("string")
    ref = F.when(F.col("n_nationkey") % 2 == 0, k).otherwise(F.concat(F.lit("r"), k))  # even ones are part of the name
    name = F.when(n != "NATION_7", n)
    return table(spark, d, "nation").select("n_nationkey", X.rendered(F.lit(" {station_name}  - {station_ref}() "), n, ref).alias("shown"), X.station_label(name, F.concat(F.lit("ref"), k), F.lit(None).cast("string")).alias("station"))


@register("f05_f06_allowed_codes", f"WITH {INDEX} SELECT timeseries_id, hour, daqi_status AS status, CASE WHEN pollutant_code = 'pm10' THEN 'pm10' WHEN pollutant_code = 'pm25' THEN 'pm25' ELSE 'no2' END AS matrix FROM idx")
def _(spark, d):
    i = index_levels.from_observations(observations(spark, d))
    status = X.allowed(F.concat(F.lit(" "), F.upper("daqi_status")), ("ok", "insufficient_samples", "missing_input", "unsupported_pollutant"))
    return i.select("timeseries_id", "hour", status.alias("status"), matrix_measure(F.regexp_replace("pollutant_code", "^pm", "PM_")).alias("matrix"))


@register("f36_row_keys", f"WITH {OBS} SELECT seq, concat_ws('|', CAST(connector_id AS VARCHAR), CAST(timeseries_id AS VARCHAR), strftime(observed_at, '%Y-%m-%d %H')) AS key FROM obs")
def _(spark, d):
    return observations(spark, d).select("seq", F.concat_ws("|", F.col("connector_id").cast("string"), F.col("timeseries_id").cast("string"), F.date_format("observed_at", "yyyy-MM-dd HH")).alias("key"))


@register("f11_source_years", f"WITH {OBS}, dd AS (SELECT DISTINCT CAST(observed_at AS DATE) AS day FROM obs) SELECT DISTINCT CAST(year(y) AS INTEGER) AS year FROM (SELECT day AS y FROM dd UNION ALL SELECT day - 1 FROM dd)")
def _(spark, d):
    days = observations(spark, d).select(F.to_date("observed_at").alias("day")).distinct()
    return days.select(F.explode(F.array("day", F.date_sub("day", 1))).alias("y")).select(F.year("y").alias("year")).distinct()


@register("d31_storage_calendar", f"""WITH {OBS}, {STORE_B}, g AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day), a AS (SELECT DISTINCT CAST(observed_at AS DATE) AS day, true AS a FROM obs), b AS (SELECT DISTINCT CAST(observed_at AS DATE) AS day, true AS b FROM store_b WHERE day(observed_at) % 6 <> 0)
  SELECT day, coalesce(a, false) AS in_a, coalesce(b, false) AS in_b FROM g LEFT JOIN a USING (day) LEFT JOIN b USING (day)""")
def _(spark, d):
    o = observations(spark, d)
    days = spark.range(1).select(F.explode(F.sequence(F.lit("2023-12-28").cast("date"), F.lit("2024-02-02").cast("date"))).alias("day"))
    has = lambda x, name: x.select(F.to_date("observed_at").alias("day")).distinct().withColumn(name, F.lit(True))
    out = days.join(has(o, "in_a"), "day", "left").join(has(store_b(o).filter(F.day("observed_at") % 6 != 0), "in_b"), "day", "left")
    return out.select("day", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("in_a", "in_b")])


@register("d42_size_metrics", f"WITH {OBS} SELECT date_trunc('hour', observed_at) AS hour, label, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT observed_at, 'a' AS label, seq AS bytes FROM obs WHERE seq % 2 = 0 UNION ALL SELECT observed_at, 'b', seq * 2 FROM obs WHERE seq % 2 = 1) GROUP BY ALL")
def _(spark, d):
    o = observations(spark, d)
    one = lambda c, label, bytes_: o.filter(c).select(hour_start("observed_at").alias("hour"), F.lit(label).alias("label"), bytes_.alias("bytes"))
    return one("seq % 2 = 0", "a", F.col("seq")).unionByName(one("seq % 2 = 1", "b", F.col("seq") * 2)).groupBy("hour", "label").agg(F.sum("bytes").alias("bytes"))


@register("d34_d35_code_directory", "WITH c AS (SELECT * FROM (SELECT p_brand AS code, p_type AS area, p_partkey, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey DESC) AS rn FROM part WHERE p_size % 5 <> 0) WHERE rn = 1) SELECT code, area, p_partkey, substr(code, 1, 7) AS shard FROM c")
def _(spark, d):
    """Live rows, the last of each code, and its shard."""
    from chronoloom.operators.windows import newest

    live = table(spark, d, "part").filter("p_size % 5 <> 0").select(F.col("p_brand").alias("code"), F.col("p_type").alias("area"), "p_partkey")
    return newest(live.withColumn("o", F.col("p_partkey")), ["code", "area"], ["o"]).select("code", "area", "p_partkey", F.substring("code", 1, 7).alias("shard"))
