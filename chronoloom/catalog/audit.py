"""Audit, gap and window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.catalog.levels import INDEX
from chronoloom.functions.time import hour_start
from chronoloom.operators import windows as W
from chronoloom.plans import audit, index_levels
from chronoloom.sources.fixtures import MEMBERS, OBS, members, observations, table

START, END = "2024-01-05", "2024-01-12"
ALIGNED = f"""{INDEX}, per_hour AS (SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, count(*) AS obs_rows FROM obs GROUP BY ALL),
lv AS (SELECT timeseries_id, hour, count(*) AS index_rows, max(daqi_level) AS daqi_level, max(eaqi_level) AS eaqi_level FROM idx GROUP BY ALL),
grid AS (SELECT timeseries_id, hour FROM (SELECT DISTINCT timeseries_id FROM obs), (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour)),
al0 AS (SELECT g.timeseries_id, g.hour, coalesce(obs_rows, 0) AS obs_rows, coalesce(index_rows, 0) AS index_rows, daqi_level, eaqi_level
  FROM grid g LEFT JOIN per_hour p ON g.timeseries_id = p.timeseries_id AND g.hour = p.hour LEFT JOIN lv l ON g.timeseries_id = l.timeseries_id AND g.hour = l.hour),
al AS (SELECT *, index_rows > 1 AS duplicate_index, CASE WHEN obs_rows > 0 AND index_rows > 0 AND daqi_level IS NOT NULL AND eaqi_level IS NOT NULL THEN 'ok' WHEN obs_rows > 0 AND index_rows = 0 THEN 'observations_without_index'
  WHEN obs_rows = 0 AND index_rows > 0 THEN 'index_without_observations' WHEN index_rows > 0 AND daqi_level IS NULL AND eaqi_level IS NULL THEN 'both_levels_missing' WHEN index_rows > 0 AND daqi_level IS NULL THEN 'first_level_missing'
  WHEN index_rows > 0 AND eaqi_level IS NULL THEN 'second_level_missing' WHEN obs_rows = 0 AND index_rows = 0 THEN 'no_data' ELSE 'other' END AS status FROM al0)"""


def _index(spark, d):
    return index_levels.from_observations(observations(spark, d))


def _aligned(spark, d):
    return audit.aligned(observations(spark, d), _index(spark, d), START, END)


@register("j08_d20_hour_alignment", f"WITH {ALIGNED} SELECT * FROM al")
def _(spark, d):
    return _aligned(spark, d)


@register("u01_a19_summary", f"""WITH {ALIGNED} SELECT 'hours' AS label, count(*) AS n FROM al UNION ALL SELECT 'hours_with_observations', count(*) FROM al WHERE obs_rows > 0
  UNION ALL SELECT 'hours_with_index', count(*) FROM al WHERE index_rows > 0 UNION ALL SELECT 'hours_ok', count(*) FROM al WHERE status = 'ok'""")
def _(spark, d):
    return audit.summary(_aligned(spark, d))


@register("a20_day_coverage", f"""WITH {ALIGNED} SELECT timeseries_id, CAST(hour AS DATE) AS day, count(*) AS hours, count(*) FILTER (obs_rows > 0) AS with_observations, count(*) FILTER (index_rows > 0) AS with_index,
  min(hour) FILTER (obs_rows > 0 AND index_rows = 0) AS first_missing FROM al GROUP BY ALL""")
def _(spark, d):
    return audit.day_coverage(_aligned(spark, d))


@register("w04_status_islands", f"""WITH {ALIGNED} SELECT timeseries_id, status, min(hour) AS start, max(hour) + INTERVAL 1 HOUR AS "end", count(*) AS hours
  FROM (SELECT *, hour - row_number() OVER (PARTITION BY timeseries_id, status ORDER BY hour) * INTERVAL 1 HOUR AS g FROM al) GROUP BY timeseries_id, status, g""")
def _(spark, d):
    return W.islands(_aligned(spark, d), ["timeseries_id", "status"])


@register("w05_band_islands", f"""WITH {ALIGNED}, b AS (SELECT timeseries_id, hour, 'daqi_level' AS scale, coalesce(daqi_level, -1) AS level FROM al UNION ALL SELECT timeseries_id, hour, 'eaqi_level', coalesce(eaqi_level, -1) FROM al)
  SELECT timeseries_id, scale, level, min(hour) AS start, max(hour) + INTERVAL 1 HOUR AS "end", count(*) AS hours
  FROM (SELECT *, hour - row_number() OVER (PARTITION BY timeseries_id, scale, level ORDER BY hour) * INTERVAL 1 HOUR AS g FROM b) GROUP BY timeseries_id, scale, level, g""")
def _(spark, d):
    a = _aligned(spark, d).withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("daqi_level", "eaqi_level")})
    return W.islands(a.unpivot(["timeseries_id", "hour"], ["daqi_level", "eaqi_level"], "scale", "level"), ["timeseries_id", "scale", "level"])


@register("a21_duplicates", f"""WITH {OBS} SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, count(*) AS n, count(DISTINCT value) AS n_distinct, string_agg(DISTINCT CAST(CAST(seq AS INTEGER) % 7 AS VARCHAR), ',' ORDER BY CAST(CAST(seq AS INTEGER) % 7 AS VARCHAR)) AS listed
  FROM obs GROUP BY ALL HAVING count(*) > 1""".replace("count(DISTINCT value)", "count(DISTINCT seq % 7)"))
def _(spark, d):
    o = observations(spark, d).select("timeseries_id", hour_start("observed_at").alias("hour"), (F.col("seq") % 7).alias("source"))
    return audit.duplicates(o, ["timeseries_id", "hour"], "source")


@register("a22_by_measure", f"""WITH {INDEX} SELECT pollutant_code, count(*) AS n, min(daqi_level) AS daqi_min, max(daqi_level) AS daqi_max, count(*) - count(daqi_level) AS daqi_null, min(eaqi_level) AS eaqi_min, max(eaqi_level) AS eaqi_max,
  count(*) - count(eaqi_level) AS eaqi_null FROM idx GROUP BY ALL""")
def _(spark, d):
    both = [x for c in ("daqi", "eaqi") for x in (F.min(f"{c}_level").alias(f"{c}_min"), F.max(f"{c}_level").alias(f"{c}_max"), F.count_if(F.col(f"{c}_level").isNull()).alias(f"{c}_null"))]
    return _index(spark, d).groupBy("pollutant_code").agg(F.count("*").alias("n"), *both)


@register("a24_status_lists", f"""WITH {INDEX} SELECT timeseries_id, array_to_string(list_sort(list_distinct(list(coalesce(daqi_reason, 'null')))), ',') AS reasons, count(*) AS n FROM idx GROUP BY ALL""")
def _(spark, d):
    return _index(spark, d).groupBy("timeseries_id").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("daqi_reason", F.lit("null")))), ",").alias("reasons"), F.count("*").alias("n"))


@register("a25_source_summary", f"WITH {OBS} SELECT timeseries_id, count(*) AS n, count(DISTINCT station_id) AS stations, count(DISTINCT pollutant_code) AS measures, min(observed_at) AS first, max(observed_at) AS last FROM obs GROUP BY ALL")
def _(spark, d):
    return observations(spark, d).groupBy("timeseries_id").agg(F.count("*").alias("n"), F.count_distinct("station_id").alias("stations"), F.count_distinct("pollutant_code").alias("measures"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))


_COUNTED = ("daqi_status", "eaqi_status", "daqi_level", "eaqi_level", "pollutant_code", "daqi_averaging")


@register("a26_a27_column_counts", f"WITH {INDEX} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'unknown') AS value, count(*) AS n FROM idx GROUP BY ALL" for c in _COUNTED))
def _(spark, d):
    return audit.column_counts(_index(spark, d), list(_COUNTED))


@register("a26_status_histogram", f"WITH {INDEX} SELECT s AS value, count(*) AS n FROM (SELECT daqi_status AS s FROM idx UNION ALL SELECT eaqi_status FROM idx) GROUP BY ALL")
def _(spark, d):
    return audit.column_counts(_index(spark, d), ["daqi_status", "eaqi_status"]).groupBy("value").agg(F.sum("n").alias("n"))


@register("a32_distinct_days", f"WITH {OBS} SELECT DISTINCT connector_id, CAST(observed_at AS DATE) AS day FROM obs WHERE observed_at < TIMESTAMP '2024-01-10'")
def _(spark, d):
    """X-11's batch form too: days with rows before the window."""
    return observations(spark, d).filter("observed_at < timestamp_ntz'2024-01-10'").select("connector_id", F.to_date("observed_at").alias("day")).distinct()


@register("p16_outside_partition", f"WITH {OBS} SELECT pollutant_code, count(*) FILTER (observed_at IS NULL) AS invalid, count(*) FILTER (NOT (observed_at >= TIMESTAMP '2024-01-02' AND observed_at < TIMESTAMP '2024-01-30')) AS outside, count(*) AS n FROM obs GROUP BY ALL")
def _(spark, d):
    t = F.col("observed_at")
    inside = (t >= F.lit("2024-01-02").cast("timestamp_ntz")) & (t < F.lit("2024-01-30").cast("timestamp_ntz"))
    return observations(spark, d).groupBy("pollutant_code").agg(F.count_if(t.isNull()).alias("invalid"), F.count_if(~inside).alias("outside"), F.count("*").alias("n"))


@register("d24_f15_expected_hours", f"""WITH {OBS}, grid AS (SELECT timeseries_id, hour FROM (SELECT DISTINCT timeseries_id FROM obs), (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour)),
  have AS (SELECT DISTINCT timeseries_id, date_trunc('hour', observed_at) AS hour FROM obs) SELECT g.timeseries_id, count(*) AS expected, count(h.hour) AS present,
  coalesce(string_agg(strftime(g.hour, '%Y-%m-%d %H'), ',' ORDER BY g.hour) FILTER (h.hour IS NULL), '') AS missing, count(*) = count(h.hour) AS complete
  FROM grid g LEFT JOIN have h ON g.timeseries_id = h.timeseries_id AND g.hour = h.hour GROUP BY ALL""")
def _(spark, d):
    return audit.missing_hours(observations(spark, d), START, END)


@register("w10_missing_hour_windows", f"""WITH {OBS}, have AS (SELECT DISTINCT timeseries_id, date_trunc('hour', observed_at) AS hour FROM obs),
  grid AS (SELECT timeseries_id, hour FROM (SELECT DISTINCT timeseries_id FROM obs), (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour)),
  miss AS (SELECT * FROM grid ANTI JOIN have USING (timeseries_id, hour)),
  iv AS (SELECT timeseries_id, hour - INTERVAL 2 HOURS AS s, hour + INTERVAL 1 HOUR AS e FROM miss),
  m AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY timeseries_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS n FROM iv),
  i AS (SELECT *, sum(n) OVER (PARTITION BY timeseries_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM m) SELECT timeseries_id, min(s) AS start, max(e) AS "end" FROM i GROUP BY timeseries_id, k""")
def _(spark, d):
    """J-10 and W-09 too."""
    o = observations(spark, d)
    grid = audit.spine(o.select("timeseries_id").distinct(), START, END)
    missing = grid.join(o.select("timeseries_id", hour_start("observed_at").alias("hour")), ["timeseries_id", "hour"], "left_anti")
    return W.hour_windows(missing, ["timeseries_id"], 2)


@register("w06_time_gaps", f"""WITH {OBS}, t AS (SELECT DISTINCT timeseries_id, observed_at FROM obs), st AS (SELECT *, lag(observed_at) OVER (PARTITION BY timeseries_id ORDER BY observed_at) AS before FROM t),
  s2 AS (SELECT *, epoch_us(observed_at) / 1e6 - epoch_us(before) / 1e6 AS step FROM st), med AS (SELECT timeseries_id, list_sort(list(step))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS m FROM s2 WHERE step > 0 GROUP BY ALL),
  lim AS (SELECT timeseries_id, greatest(1.6 * greatest(900.0, m), greatest(900.0, m) + 1200) AS l FROM med), ends AS (SELECT timeseries_id, min(observed_at) AS a, max(observed_at) AS b FROM obs GROUP BY ALL)
  SELECT timeseries_id, before AS start, observed_at AS "end" FROM s2 JOIN lim USING (timeseries_id) WHERE step > l
  UNION ALL SELECT timeseries_id, TIMESTAMP '2023-12-31', a FROM ends JOIN lim USING (timeseries_id) WHERE epoch_us(a) / 1e6 - epoch_us(TIMESTAMP '2023-12-31') / 1e6 > l
  UNION ALL SELECT timeseries_id, b, TIMESTAMP '2024-02-02' FROM ends JOIN lim USING (timeseries_id) WHERE epoch_us(TIMESTAMP '2024-02-02') / 1e6 - epoch_us(b) / 1e6 > l""")
def _(spark, d):
    return W.time_gaps(observations(spark, d), "2023-12-31", "2024-02-02", 900)


@register("w07_changes_only", """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER w AS rn, lag(o_orderpriority) OVER w AS b FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE rn = 1 OR b IS DISTINCT FROM o_orderpriority""")
def _(spark, d):
    return W.changes(table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderpriority"]).select("o_custkey", "o_orderkey", "o_orderpriority")


_SNAP = "snap AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderpriority) AS state FROM orders GROUP BY ALL)"


def _snapshots(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.min("o_orderpriority").alias("state"))


@register("w08_closed_intervals", f"""WITH {_SNAP}, ch AS (SELECT * FROM (SELECT *, row_number() OVER w AS rn, lag(state) OVER w AS b FROM snap WINDOW w AS (PARTITION BY o_custkey ORDER BY day)) WHERE rn = 1 OR b <> state)
  SELECT o_custkey, day, state, CAST(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - INTERVAL 1 DAY AS DATE) AS until FROM ch""")
def _(spark, d):
    return W.closed_intervals(W.changes(_snapshots(spark, d), "o_custkey", ["day"], ["state"]), "o_custkey", "day")


@register("w14_interval_faults", f"WITH {OBS}, {MEMBERS} SELECT station_id, CAST(coalesce(sum(o), 0) AS BIGINT) AS overlaps, count(*) FILTER (valid_to IS NULL) AS open_ends, coalesce(sum(o), 0) = 0 AND count(*) FILTER (valid_to IS NULL) <= 1 AS valid FROM (SELECT *, CASE WHEN valid_from <= max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY station_id ORDER BY valid_from, coalesce(valid_to, DATE '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM members) GROUP BY ALL")
def _(spark, d):
    return W.interval_faults(members(observations(spark, d)), "station_id")


@register("w11_latest_row", f"WITH {OBS} SELECT timeseries_id, observed_at, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id ORDER BY observed_at DESC, seq DESC) AS rn FROM obs) WHERE rn = 1")
def _(spark, d):
    return W.newest(observations(spark, d).select("timeseries_id", "observed_at", "seq", "value"), ["timeseries_id"], ["observed_at", "seq"])


@register("w12_latest_run", "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END, o_orderdate) DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def _(spark, d):
    """W-13 and D-43 too."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")), F.col("o_orderdate")).alias("at"))
    return W.newest(o, ["o_custkey"], ["at", "o_orderkey"]).drop("at")


@register("w03_s18_chunks", f"WITH {OBS} SELECT timeseries_id, seq, CAST(floor((row_number() OVER (PARTITION BY timeseries_id ORDER BY observed_at, seq) - 1) / 100) AS BIGINT) AS chunk FROM obs")
def _(spark, d):
    return W.numbered_chunks(observations(spark, d), ["timeseries_id"], ["observed_at", "seq"], 100).select("timeseries_id", "seq", "chunk")
