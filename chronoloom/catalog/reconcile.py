"""Guideline and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.catalog.levels import INDEX
from chronoloom.functions.time import hour_start
from chronoloom.operators import sets as S
from chronoloom.plans import guideline as G
from chronoloom.plans import index_levels
from chronoloom.plans import reconcile as R
from chronoloom.sources.fixtures import OBS, STORE_B, bindings, observations, store_b

K = "connector_id, station_id, timeseries_id, pollutant_code"


def _g(i):
    return "CASE pollutant_code " + " ".join(f"WHEN '{m}' THEN {g[i]}" for m, g in G.GUIDELINES.items()) + " END"


DAYS = f"""{OBS}, hr AS (SELECT {K}, CAST(observed_at - INTERVAL 1 MICROSECOND AS DATE) AS day, date_trunc('hour', observed_at) AS hour, avg(CASE WHEN value >= 0 THEN value END) AS m
  FROM obs WHERE pollutant_code IN ('no2', 'pm25', 'pm10') GROUP BY ALL), days AS (SELECT {K}, day, count(m) AS valid_hours, CASE WHEN count(m) >= 18 THEN avg(m) END AS daily_mean FROM hr GROUP BY ALL)"""
STATUS = f"""{DAYS}, st0 AS (SELECT s.*, d.valid_hours, d.daily_mean, coalesce(d.valid_hours >= 18, false) AS has_enough_data FROM (SELECT DISTINCT {K}, CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day FROM days) s
  LEFT JOIN days d ON s.timeseries_id = d.timeseries_id AND s.day = d.day),
st AS (SELECT *, CASE WHEN has_enough_data THEN daily_mean > {_g(0)} END AS above_daily, CASE WHEN valid_hours IS NULL THEN 'no_data' WHEN NOT has_enough_data THEN 'not_enough_data' WHEN daily_mean > {_g(0)} THEN 'above_guideline' ELSE 'within_guideline' END AS status,
  round(least(100.0, 100.0 * coalesce(valid_hours, 0) / 24) + 1e-9, 1) AS completeness FROM st0)"""
R6 = "round(period_mean + 1e-9, 6) AS period_mean"
ROLL = f"""{DAYS}, ry0 AS (SELECT {K}, day AS as_of, avg(daily_mean) OVER w AS period_mean, count(daily_mean) OVER w AS valid_days, CAST(sum(valid_hours) OVER w AS BIGINT) AS valid_hours, CAST(sum(CASE WHEN daily_mean > {_g(0)} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS days_above FROM days
  WINDOW w AS (PARTITION BY timeseries_id ORDER BY day RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND CURRENT ROW)),
ry AS (SELECT *, 10 AS min_days, valid_days >= 10 AS has_enough_data, CASE WHEN valid_days >= 10 THEN period_mean > {_g(1)} END AS above_yearly, CASE WHEN valid_days >= 10 THEN days_above > 3 END AS above_daily_approach FROM ry0)"""
CAL = f"""{DAYS}, cy0 AS (SELECT {K}, CAST(year(day) AS INTEGER) AS year, avg(daily_mean) AS period_mean, count(daily_mean) AS valid_days, CAST(sum(CASE WHEN daily_mean > {_g(0)} THEN 1 ELSE 0 END) AS BIGINT) AS days_above FROM days WHERE day <= DATE '2024-01-25' GROUP BY ALL),
cy1 AS (SELECT *, date_diff('day', make_date(year, 1, 1), least(make_date(year, 12, 31), DATE '2024-01-25')) + 1 AS period_days, CASE WHEN make_date(year, 12, 31) <= DATE '2024-01-25' THEN 'complete_year' ELSE 'year_to_date' END AS kind FROM cy0),
cy2 AS (SELECT *, CASE WHEN kind = 'complete_year' THEN 274 ELSE least(period_days, greatest(14, ceil(period_days * 0.75))) END AS min_days FROM cy1),
cy AS (SELECT * REPLACE (CAST(min_days AS INTEGER) AS min_days, CAST(period_days AS INTEGER) AS period_days), valid_days >= min_days AS has_enough_data, CASE WHEN valid_days >= min_days THEN period_mean > {_g(1)} END AS above_yearly, CASE WHEN valid_days >= min_days THEN days_above > 3 END AS above_daily_approach FROM cy2)"""


def _r(df, c):
    return df.withColumn(c, F.round(F.col(c) + 1e-9, 6))


def _days(spark, d):
    return G.daily_means(observations(spark, d))


def _status(spark, d):
    return G.daily_status(_days(spark, d), "2024-01-01", "2024-02-02")


@register("a03_d06_daily_means", f"WITH {DAYS} SELECT * REPLACE (round(daily_mean + 1e-9, 6) AS daily_mean) FROM days")
def _(spark, d):
    """P-05 too."""
    return _r(_days(spark, d), "daily_mean")


@register("d07_daily_status", f"WITH {STATUS} SELECT * REPLACE (round(daily_mean + 1e-9, 6) AS daily_mean) FROM st")
def _(spark, d):
    return _r(_status(spark, d), "daily_mean")


@register("a04_d08_rolling_year", f"WITH {ROLL} SELECT * REPLACE ({R6}) FROM ry")
def _(spark, d):
    """Fourteen days and ten valid ones, since the data span a month."""
    return _r(G.rolling_year(_days(spark, d), 14, 10), "period_mean")


@register("d09_calendar_year", f"WITH {CAL} SELECT * REPLACE ({R6}) FROM cy")
def _(spark, d):
    return _r(G.calendar_year(_days(spark, d), "2024-01-25"), "period_mean")


@register("a05_summary_cards", f"""WITH {CAL}, {STATUS[len(DAYS) + 2:]}, ev AS (SELECT pollutant_code, 'yearly' AS card, above_yearly AS above FROM cy UNION ALL SELECT pollutant_code, 'daily_approach', above_daily_approach FROM cy UNION ALL SELECT pollutant_code, 'daily', above_daily FROM st)
  SELECT pollutant_code, card, count(above) AS with_data, count(*) FILTER (above) AS above, count(*) FILTER (NOT above) AS within, CASE WHEN count(above) > 0 THEN round(100.0 * count(*) FILTER (above) / count(above) + 1e-9, 1) END AS percent_above FROM ev GROUP BY ALL""")
def _(spark, d):
    return G.cards(G.calendar_year(_days(spark, d), "2024-01-25"), _status(spark, d))


@register("a06_readiness", f"""WITH {OBS}, el AS (SELECT DISTINCT timeseries_id, pollutant_code FROM obs), h AS (SELECT DISTINCT timeseries_id, 1 AS r FROM obs WHERE observed_at >= TIMESTAMP '2024-01-10 12:00:00' AND observed_at < TIMESTAMP '2024-01-10 13:00:00'),
  o AS (SELECT pollutant_code, count(*) AS eligible, count(r) AS ready, round(count(r) / count(*) + 1e-9, 4) AS share, count(r) = count(*) AS is_ready FROM el LEFT JOIN h USING (timeseries_id) GROUP BY ALL)
  SELECT *, (SELECT bool_and(is_ready) FROM o) AS all_ready, (SELECT bool_or(is_ready) FROM o) AS any_ready FROM o""")
def _(spark, d):
    o = observations(spark, d)
    return G.readiness(o, o.select("timeseries_id", "pollutant_code").distinct(), "2024-01-10 12:00:00")


@register("a07_merged_chunks", f"""WITH {OBS}, c AS (SELECT pollutant_code, connector_id, count(*) AS n, count(DISTINCT timeseries_id) AS candidates FROM obs GROUP BY ALL)
  SELECT pollutant_code, max(candidates) AS candidates, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL""")
def _(spark, d):
    c = observations(spark, d).groupBy("pollutant_code", "connector_id").agg(F.count("*").alias("n"), F.count_distinct("timeseries_id").alias("candidates"))
    return c.groupBy("pollutant_code").agg(F.max("candidates").alias("candidates"), F.sum("n").alias("n"))


@register("t07_newest_usable_day", f"WITH {STATUS} SELECT pollutant_code, max(day) AS day FROM st WHERE has_enough_data GROUP BY ALL")
def _(spark, d):
    return _status(spark, d).filter("has_enough_data").groupBy("pollutant_code").agg(F.max("day").alias("day"))


_LEVELS = {"daqi": 10, "eaqi": 6}


def _hist(unit):
    slots = ", ".join(f"count(*) FILTER (daqi_level = {i})" for i in range(1, 11))
    slots6 = ", ".join(f"count(*) FILTER (eaqi_level = {i})" for i in range(1, 7))
    return f"WITH {INDEX} SELECT station_id, date_trunc('{unit}', hour) AS period, [{slots}] AS daqi_hours, [{slots6}] AS eaqi_hours, max(daqi_level) AS worst, count(daqi_level) AS valid_hours FROM idx GROUP BY ALL"


def _histogram(spark, d, unit):
    slot = lambda s: F.array(*[F.count_if(F.coalesce(F.col(f"{s}_level") == i, F.lit(False))) for i in range(1, _LEVELS[s] + 1)]).alias(f"{s}_hours")
    return index_levels.from_observations(observations(spark, d)).groupBy("station_id", F.date_trunc(unit, "hour").cast("timestamp_ntz").alias("period")).agg(slot("daqi"), slot("eaqi"), F.max("daqi_level").alias("worst"), F.count("daqi_level").alias("valid_hours"))


@register("a28_daily_histogram", _hist("day").replace("[count", "[count"))
def _(spark, d):
    return _histogram(spark, d, "day")


@register("a28_monthly_histogram", _hist("month"))
def _(spark, d):
    return _histogram(spark, d, "month")


# Reconciliation. Both engines write a row in the same form.
TEXT = "concat_ws('|', CAST(timeseries_id AS VARCHAR), strftime(observed_at, '%Y-%m-%d %H:%M:%S.%f'), CAST(value + 0.0 AS VARCHAR))"
FP = f"""{OBS}, {STORE_B},
fa AS (SELECT connector_id, date_trunc('hour', observed_at) AS hour, count(*) AS n, sha256(string_agg(sha256({TEXT}), chr(10) ORDER BY sha256({TEXT}))) AS fingerprint, min(observed_at) AS first, max(observed_at) AS last FROM obs GROUP BY ALL),
fb AS (SELECT connector_id, date_trunc('hour', observed_at) AS hour, count(*) AS n, sha256(string_agg(sha256({TEXT}), chr(10) ORDER BY sha256({TEXT}))) AS fingerprint FROM store_b GROUP BY ALL),
cmp AS (SELECT coalesce(a.connector_id, b.connector_id) AS connector_id, coalesce(a.hour, b.hour) AS hour, a.n AS n_a, b.n AS n_b, CASE WHEN a.n IS NULL THEN 'extra_in_b' WHEN b.n IS NULL THEN 'missing_in_b' WHEN a.n <> b.n THEN 'count_mismatch'
  WHEN a.fingerprint <> b.fingerprint THEN 'fingerprint_mismatch' ELSE 'deletable' END AS result FROM fa a FULL JOIN fb b ON a.connector_id = b.connector_id AND a.hour = b.hour)"""


def _compared(spark, d):
    a = observations(spark, d)
    return R.compared(R.hour_buckets(a), R.hour_buckets(store_b(a)), ["connector_id", "hour"])


@register("a08_hour_fingerprints", f"WITH {FP} SELECT * FROM fa")
def _(spark, d):
    return R.hour_buckets(observations(spark, d))


@register("j07_d10_compared_buckets", f"WITH {FP} SELECT * FROM cmp")
def _(spark, d):
    return _compared(spark, d)


@register("d11_repairs", f"WITH {FP} SELECT *, CASE WHEN result = 'count_mismatch' AND n_b > n_a THEN 'other_store_has_more' ELSE 'repairable' END AS repair FROM cmp WHERE result NOT IN ('deletable', 'extra_in_b')")
def _(spark, d):
    return R.repairs(_compared(spark, d))


def _gate(a):
    return a.select("connector_id", F.to_date("observed_at").alias("day")).distinct().withColumn("complete", F.day("day") % 5 != 0)


GATE = "gate AS (SELECT DISTINCT connector_id, CAST(observed_at AS DATE) AS day, day(observed_at) % 5 <> 0 AS complete FROM obs)"


@register("d12_deletion_plan", f"""WITH {FP}, {GATE}, dd AS (SELECT connector_id, CAST(hour AS DATE) AS day, count(*) AS buckets, count(*) FILTER (result = 'deletable') AS eligible FROM cmp WHERE n_a IS NOT NULL GROUP BY ALL),
  rr AS (SELECT dd.*, CASE WHEN NOT coalesce(complete, false) THEN 'history_not_complete_for_connector_day' WHEN eligible <> buckets THEN 'connector_day_not_fully_eligible' END AS reason FROM dd LEFT JOIN gate USING (connector_id, day))
  SELECT connector_id, day, buckets, eligible, reason IS NULL AS planned, reason FROM rr""")
def _(spark, d):
    a = observations(spark, d)
    return R.deletion_plan(_compared(spark, d), _gate(a))


@register("j13_gate_filter", f"WITH {FP}, {GATE} SELECT f.connector_id, hour, n FROM fa f SEMI JOIN (SELECT * FROM gate WHERE complete) g ON f.connector_id = g.connector_id AND CAST(f.hour AS DATE) = g.day")
def _(spark, d):
    a = observations(spark, d)
    return R.hour_buckets(a).withColumn("day", F.to_date("hour")).join(_gate(a).filter("complete"), ["connector_id", "day"], "left_semi").select("connector_id", "hour", "n")


@register("a09_a10_partition_hash", f"""WITH {OBS}, p AS (SELECT connector_id, CAST(observed_at AS DATE) AS day, pollutant_code, date_trunc('hour', observed_at) AS hour, count(*) AS n, sha256(string_agg(sha256({TEXT}), chr(10) ORDER BY sha256({TEXT}))) AS fingerprint FROM obs GROUP BY ALL)
  SELECT connector_id, day, pollutant_code, CAST(sum(n) AS BIGINT) AS n, sha256('observations/1' || chr(10) || string_agg(fingerprint, chr(10) ORDER BY hour)) AS fingerprint FROM p GROUP BY ALL""")
def _(spark, d):
    o = observations(spark, d).withColumns({"hour": hour_start("observed_at"), "day": F.to_date("observed_at")})
    keys = ["connector_id", "day", "pollutant_code"]
    return R.rolled_up(R.fingerprints(o, [*keys, "hour"]), keys, ["hour"], "observations/1\n")


@register("a14_month_year_root", f"""WITH {FP}, m AS (SELECT date_trunc('day', hour) AS day, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(fingerprint, chr(10) ORDER BY connector_id, hour)) AS fingerprint FROM fa GROUP BY ALL),
  mo AS (SELECT CAST(year(day) AS INTEGER) AS y, CAST(month(day) AS INTEGER) AS m, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(fingerprint, chr(10) ORDER BY day)) AS fingerprint FROM m GROUP BY ALL), ye AS (SELECT y, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(fingerprint, chr(10) ORDER BY m)) AS fingerprint FROM mo GROUP BY ALL)
  SELECT y, m, n, fingerprint FROM mo UNION ALL SELECT y, NULL, n, fingerprint FROM ye UNION ALL SELECT NULL, NULL, CAST(sum(n) AS BIGINT), sha256(string_agg(fingerprint, chr(10) ORDER BY y)) FROM ye""")
def _(spark, d):
    day = R.rolled_up(R.hour_buckets(observations(spark, d)).withColumn("day", F.to_date("hour")), ["day"], ["connector_id", "hour"])
    month = R.rolled_up(day.withColumns({"y": F.year("day"), "m": F.month("day")}), ["y", "m"], ["day"])
    year = R.rolled_up(month, ["y"], ["m"])
    root = R.rolled_up(year.withColumn("all", F.lit(0)), ["all"], ["y"]).drop("all")
    return month.unionByName(year, allowMissingColumns=True).unionByName(root, allowMissingColumns=True)


@register("d30_j12_changed_partitions", f"""WITH {FP}, a AS (SELECT connector_id, CAST(hour AS DATE) AS day, sha256(string_agg(fingerprint, chr(10) ORDER BY hour)) AS f FROM fa GROUP BY ALL), b AS (SELECT connector_id, CAST(hour AS DATE) AS day, sha256(string_agg(fingerprint, chr(10) ORDER BY hour)) AS f FROM fb GROUP BY ALL)
  SELECT a.connector_id, a.day, CASE WHEN b.f IS NULL THEN 'new' WHEN a.f <> b.f THEN 'changed' ELSE 'same' END AS state FROM a LEFT JOIN b ON a.connector_id = b.connector_id AND a.day = b.day""")
def _(spark, d):
    """S-19 and D-41 too: what an incremental copy has to write."""
    a = observations(spark, d)
    day = lambda o: R.rolled_up(R.hour_buckets(o).withColumn("day", F.to_date("hour")), ["connector_id", "day"], ["hour"])
    now, before = day(a), day(store_b(a)).select("connector_id", "day", F.col("fingerprint").alias("f"))
    state = F.when(F.col("f").isNull(), "new").when(F.col("f") != F.col("fingerprint"), "changed").otherwise("same")
    return now.join(before, ["connector_id", "day"], "left").select("connector_id", "day", state.alias("state"))


@register("d16_multiset_report", f"""WITH {OBS}, {STORE_B}, n AS (SELECT pollutant_code, timeseries_id, observed_at, value, sum(l) AS l, sum(r) AS r FROM (SELECT *, 1 AS l, 0 AS r FROM obs UNION ALL SELECT *, 0, 1 FROM store_b) GROUP BY pollutant_code, timeseries_id, observed_at, value)
  SELECT pollutant_code, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right, CAST(sum(least(l, r)) AS BIGINT) AS matched, CAST(sum(greatest(l - r, 0)) AS BIGINT) AS missing, CAST(sum(greatest(r - l, 0)) AS BIGINT) AS unexpected FROM n GROUP BY ALL""")
def _(spark, d):
    """U-06 too."""
    a = observations(spark, d)
    return R.multiset_report(a, store_b(a), ["pollutant_code", "timeseries_id", "observed_at", "value"], "pollutant_code")


@register("u06_except_all", f"WITH {OBS}, {STORE_B} SELECT timeseries_id, observed_at, value FROM obs EXCEPT ALL SELECT timeseries_id, observed_at, value FROM store_b")
def _(spark, d):
    a, c = observations(spark, d), ["timeseries_id", "observed_at", "value"]
    return a.select(c).exceptAll(store_b(a).select(c))


@register("u06_intersect_all", f"WITH {OBS}, {STORE_B} SELECT timeseries_id, observed_at, value FROM obs INTERSECT ALL SELECT timeseries_id, observed_at, value FROM store_b")
def _(spark, d):
    a, c = observations(spark, d), ["timeseries_id", "observed_at", "value"]
    return a.select(c).intersectAll(store_b(a).select(c))


@register("u07_schema_union", f"WITH {OBS} SELECT timeseries_id, pollutant_code, '' AS status FROM obs WHERE seq % 2 = 0 UNION ALL SELECT timeseries_id, '' , 'P' FROM obs WHERE seq % 2 = 1")
def _(spark, d):
    o = observations(spark, d)
    both = o.filter("seq % 2 = 0").select("timeseries_id", "pollutant_code").unionByName(o.filter("seq % 2 = 1").select("timeseries_id", F.lit("P").alias("status")), allowMissingColumns=True)
    return both.select("timeseries_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("pollutant_code", "status")])


@register("u08_set_difference", f"WITH {OBS}, {STORE_B}, a AS (SELECT DISTINCT timeseries_id, date_trunc('hour', observed_at) AS hour FROM obs), b AS (SELECT DISTINCT timeseries_id, date_trunc('hour', observed_at) AS hour FROM store_b) SELECT *, 'left' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def _(spark, d):
    hours = lambda o: o.select("timeseries_id", hour_start("observed_at").alias("hour"))
    a = observations(spark, d)
    return S.set_difference(hours(a), hours(store_b(a)))


@register("u09_day_union", f"WITH {OBS}, {STORE_B} SELECT DISTINCT CAST(observed_at AS DATE) AS day FROM (SELECT observed_at FROM obs UNION ALL SELECT observed_at FROM store_b)")
def _(spark, d):
    a = observations(spark, d)
    return a.select("observed_at").union(store_b(a).select("observed_at")).select(F.to_date("observed_at").alias("day")).distinct()


@register("u10_unclaimed_days", f"WITH {OBS} SELECT DISTINCT connector_id, CAST(observed_at AS DATE) AS day FROM obs WHERE NOT (day(observed_at) % 3 = 0 AND connector_id = 1)")
def _(spark, d):
    days = observations(spark, d).select("connector_id", F.to_date("observed_at").alias("day")).distinct()
    done = days.filter((F.day("day") % 3 == 0) & (F.col("connector_id") == 1))
    return days.join(done, ["connector_id", "day"], "left_anti")


@register("u02_precedence", f"""WITH {OBS}, {STORE_B} SELECT timeseries_id, observed_at, value, source FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id, observed_at ORDER BY p, v DESC) AS rn FROM (
  SELECT timeseries_id, observed_at, max(value) AS value, 'a' AS source, 0 AS p, 0 AS v FROM obs WHERE seq % 3 = 0 GROUP BY ALL UNION ALL SELECT timeseries_id, observed_at, max(value), 'b', 1, 0 FROM store_b GROUP BY ALL)) WHERE rn = 1""")
def _(spark, d):
    """U-03 is this with the sides exchanged."""
    a, k = observations(spark, d), ["timeseries_id", "observed_at"]
    one = lambda o, s: o.groupBy(*k).agg(F.max("value").alias("value")).withColumn("source", F.lit(s))
    return S.prefer(one(a.filter("seq % 3 = 0"), "a"), one(store_b(a), "b"), k)


@register("u05_field_merge", f"WITH {OBS}, f AS (SELECT seq, CASE WHEN seq % 2 = 0 THEN value END AS value, pollutant_code FROM obs WHERE seq % 3 <> 0), s AS (SELECT seq, value * 2 AS value, CASE WHEN seq % 5 = 0 THEN 'x' END AS pollutant_code FROM obs WHERE seq % 4 <> 0) SELECT coalesce(f.seq, s.seq) AS seq, coalesce(f.value, s.value) AS value, coalesce(f.pollutant_code, s.pollutant_code) AS pollutant_code FROM f FULL JOIN s ON f.seq = s.seq")
def _(spark, d):
    o = observations(spark, d)
    first = o.filter("seq % 3 <> 0").select("seq", F.when(F.col("seq") % 2 == 0, F.col("value")).alias("value"), "pollutant_code")
    second = o.filter("seq % 4 <> 0").select("seq", (F.col("value") * 2).alias("value"), F.when(F.col("seq") % 5 == 0, "x").alias("pollutant_code"))
    return S.merged_fields(first, second, ["seq"])


@register("d19_restore_plan", f"""WITH {OBS}, {STORE_B}, a AS (SELECT timeseries_id, observed_at, min(value) AS value_a, count(DISTINCT value) AS na FROM obs GROUP BY ALL), b AS (SELECT timeseries_id, observed_at, min(value) AS value_b, count(DISTINCT value) AS nb FROM store_b GROUP BY ALL),
  j AS (SELECT a.timeseries_id, a.observed_at, value_a, value_b, CASE WHEN na > 1 THEN 'conflicting_repeats' WHEN nb IS NULL THEN 'missing' WHEN nb > 1 OR value_a <> value_b THEN 'conflict' END AS action FROM a LEFT JOIN b ON a.timeseries_id = b.timeseries_id AND a.observed_at = b.observed_at) SELECT * FROM j WHERE action IS NOT NULL""")
def _(spark, d):
    a = observations(spark, d)
    return R.restore_plan(a, store_b(a))


@register("d17_tolerance_difference", f"""WITH {OBS}, {STORE_B}, a AS (SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, max(value) AS hi, count(*) AS n FROM obs GROUP BY ALL), b AS (SELECT timeseries_id, date_trunc('hour', observed_at) AS hour, max(value) AS hi, count(*) AS n FROM store_b GROUP BY ALL),
  j AS (SELECT coalesce(a.timeseries_id, b.timeseries_id) AS timeseries_id, coalesce(a.hour, b.hour) AS hour, a.hi AS ah, b.hi AS bh, a.n AS an, b.n AS bn FROM a FULL JOIN b ON a.timeseries_id = b.timeseries_id AND a.hour = b.hour)
  SELECT timeseries_id, hour, NULL AS field, NULL::DOUBLE AS "left", NULL::DOUBLE AS "right", CASE WHEN bn IS NULL THEN 'missing' ELSE 'extra' END AS kind FROM j WHERE an IS NULL OR bn IS NULL
  UNION ALL SELECT timeseries_id, hour, 'hi', ah, bh, 'mismatch' FROM j WHERE abs(ah - bh) > 0.5 UNION ALL SELECT timeseries_id, hour, 'n', an, bn, 'mismatch' FROM j WHERE abs(an - bn) > 0.5""")
def _(spark, d):
    """D-18 and F-37 too."""
    f = lambda o: o.groupBy("timeseries_id", hour_start("observed_at").alias("hour")).agg(F.max("value").alias("hi"), F.count("*").cast("double").alias("n"))
    a = observations(spark, d)
    return R.tolerance_difference(f(a), f(store_b(a)), ["timeseries_id", "hour"], ["hi", "n"], 0.5)


@register("d15_store_counts", f"""WITH {OBS}, {STORE_B}, c AS (SELECT 'a' AS store, CAST(observed_at AS DATE) AS day, connector_id, count(*) AS n FROM obs GROUP BY ALL UNION ALL SELECT 'b', CAST(observed_at AS DATE), connector_id, count(*) FROM store_b GROUP BY ALL
  UNION ALL SELECT 'c', CAST(observed_at AS DATE), connector_id, count(*) FROM obs WHERE day(observed_at) % 4 <> 0 GROUP BY ALL),
  p AS (SELECT day, connector_id, CAST(sum(n) FILTER (store = 'a') AS BIGINT) AS a, CAST(sum(n) FILTER (store = 'b') AS BIGINT) AS b, CAST(sum(n) FILTER (store = 'c') AS BIGINT) AS c FROM c GROUP BY ALL)
  SELECT *, b - a AS diff_b, c - a AS diff_c, CASE WHEN a IS NOT NULL AND b IS NOT DISTINCT FROM a AND c IS NOT DISTINCT FROM a THEN 'ok' ELSE concat_ws('|', CASE WHEN a IS NULL THEN 'a_missing' END, CASE WHEN b IS NULL THEN 'b_missing' WHEN b <> a THEN 'b_differs' END, CASE WHEN c IS NULL THEN 'c_missing' WHEN c <> a THEN 'c_differs' END) END AS status FROM p""")
def _(spark, d):
    """F-39 too."""
    a = observations(spark, d)
    n = lambda o, s: o.groupBy(F.to_date("observed_at").alias("day"), "connector_id").agg(F.count("*").alias("n")).withColumn("store", F.lit(s))
    return R.store_counts(n(a, "a").unionByName(n(store_b(a), "b")).unionByName(n(a.filter(F.day("observed_at") % 4 != 0), "c")), ["a", "b", "c"])


@register("f38_percent_sample", """WITH h AS (SELECT o_orderkey, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST(o_orderkey AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: (a * 31 + b) % 4294967296) AS h FROM orders) SELECT o_orderkey FROM h WHERE h % 100 < 25""")
def _(spark, d):
    from chronoloom.sources.fixtures import table

    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("t"))
    return R.sampled(o, "t", 25).select("o_orderkey")


@register("j05_j06_full_outer", f"WITH {OBS}, {STORE_B}, a AS (SELECT connector_id, pollutant_code, CAST(observed_at AS DATE) AS day, count(*) AS n_a FROM obs WHERE seq % 2 = 0 GROUP BY ALL), b AS (SELECT connector_id, pollutant_code, CAST(observed_at AS DATE) AS day, count(*) AS n_b FROM store_b WHERE seq % 7 = 1 GROUP BY ALL) SELECT coalesce(a.connector_id, b.connector_id) AS connector_id, coalesce(a.pollutant_code, b.pollutant_code) AS pollutant_code, coalesce(a.day, b.day) AS day, n_a, n_b FROM a FULL JOIN b ON a.connector_id = b.connector_id AND a.pollutant_code = b.pollutant_code AND a.day = b.day")
def _(spark, d):
    k = ["connector_id", "pollutant_code", F.to_date("observed_at").alias("day")]
    a = observations(spark, d)
    left = a.filter("seq % 2 = 0").groupBy(*k).agg(F.count("*").alias("n_a"))
    right = store_b(a).filter("seq % 7 = 1").groupBy(*k).agg(F.count("*").alias("n_b"))
    return left.join(right, ["connector_id", "pollutant_code", "day"], "full_outer")


@register("j01_bound_rows", f"WITH {OBS} SELECT timeseries_id, seq, value FROM obs WHERE timeseries_id <> 51")
def _(spark, d):
    """D-40 too. The bindings' side is broadcast by Spark where it is small."""
    o = observations(spark, d)
    return o.join(bindings(o).select("timeseries_id"), "timeseries_id").select("timeseries_id", "seq", "value")
