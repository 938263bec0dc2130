"""Interval, stitching, latest-value and outbox queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.functions.time import hour_end
from chronoloom.operators import hourly as H
from chronoloom.operators import intervals as I
from chronoloom.operators import windows as W
from chronoloom.plans import latest as L
from chronoloom.plans import stitch as T
from chronoloom.sources.fixtures import BINDINGS, MEMBERS, OBS, STORE_B, bindings, members, observations, store_b, table

A, B = "2024-01-05", "2024-01-20"


@register("j14_member_at", f"WITH {OBS}, {MEMBERS} SELECT o.seq, o.station_id, m.timeseries_id AS member_id FROM obs o JOIN members m ON o.station_id = m.station_id AND CAST(o.observed_at AS DATE) BETWEEN m.valid_from AND coalesce(m.valid_to, DATE '9999-12-31')")
def _(spark, d):
    o = observations(spark, d)
    return I.member_at(o, members(o), "station_id", "observed_at").select("seq", "station_id", "member_id")


@register("j15_clipped_members", f"""WITH {OBS}, {MEMBERS}, seg AS (SELECT station_id, timeseries_id, greatest(CAST(valid_from AS TIMESTAMP), TIMESTAMP '2023-12-20') AS start, least(coalesce(CAST(valid_to + 1 AS TIMESTAMP), TIMESTAMP '2024-01-20'), TIMESTAMP '2024-01-20') AS "end" FROM members),
  g AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY station_id ORDER BY start), TIMESTAMP '2023-12-20') AS b FROM seg WHERE start < "end")
  SELECT station_id, timeseries_id, start, "end" FROM g UNION ALL SELECT station_id, NULL, b, start FROM g WHERE b < start UNION ALL SELECT station_id, NULL, max("end"), TIMESTAMP '2024-01-20' FROM g GROUP BY station_id HAVING max("end") < TIMESTAMP '2024-01-20'""")
def _(spark, d):
    return I.clipped(members(observations(spark, d)), "station_id", "2023-12-20", "2024-01-20")


_SNAP = """snap AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderpriority) AS state FROM orders GROUP BY ALL),
ch AS (SELECT * EXCLUDE (rn, b) FROM (SELECT *, row_number() OVER w AS rn, lag(state) OVER w AS b FROM snap WINDOW w AS (PARTITION BY o_custkey ORDER BY day)) WHERE rn = 1 OR b <> state),
iv AS (SELECT *, CAST(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - INTERVAL 1 DAY AS DATE) AS until FROM ch)"""


def _intervals(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.min("o_orderpriority").alias("state"))
    return W.closed_intervals(W.changes(s, "o_custkey", ["day"], ["state"]), "o_custkey", "day")


@register("j16_d36_identity_timeline", f"""WITH {_SNAP}, days AS (SELECT DISTINCT o_custkey, CAST(make_date(year(o_orderdate), month(o_orderdate), 1) AS DATE) AS shown FROM orders)
  SELECT d.o_custkey, d.shown, count(i.day) AS intervals, max(i.state) AS state, count(i.day) > 1 AS fault FROM days d LEFT JOIN iv i ON d.o_custkey = i.o_custkey AND d.shown BETWEEN i.day AND coalesce(i.until, DATE '9999-12-31') GROUP BY ALL""")
def _(spark, d):
    """W-07 and W-08 under it."""
    days = table(spark, d, "orders").select("o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("shown")).distinct()
    return I.days_covered(days, _intervals(spark, d), "o_custkey", "shown", "day", "until")


@register("j17_d37_overlaps", """WITH r AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS e FROM lineitem)
  SELECT a.l_orderkey, a.l_linenumber AS a, b.l_linenumber AS b, CAST(date_diff('day', greatest(a.s, b.s), least(a.e, b.e)) + 1 AS INTEGER) AS days, CASE WHEN a.s = b.s AND a.e = b.e THEN 'same' WHEN a.s <= b.s AND a.e >= b.e THEN 'contains' WHEN b.s <= a.s AND b.e >= a.e THEN 'inside' ELSE 'partial' END AS relation
  FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.s <= b.e AND b.s <= a.e""")
def _(spark, d):
    r = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("s"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("e"))
    return I.overlaps(r, "l_orderkey", "l_linenumber", "s", "e")


STITCH = f"""{OBS}, {STORE_B}, prim AS (SELECT * FROM obs WHERE observed_at >= TIMESTAMP '2024-01-08' AND observed_at < TIMESTAMP '2024-01-16' AND timeseries_id <> 40), wanted AS (SELECT DISTINCT timeseries_id FROM obs),
have AS (SELECT timeseries_id, min(observed_at) AS f, max(observed_at) AS l FROM prim WHERE observed_at >= TIMESTAMP '{A}' AND observed_at < TIMESTAMP '{B}' GROUP BY ALL),
cand AS (SELECT * FROM (SELECT timeseries_id, TIMESTAMP '{A}' AS start, coalesce(f, TIMESTAMP '{B}') AS "end", CASE WHEN f IS NULL THEN 'empty_window' ELSE 'uncovered_head' END AS reason FROM wanted LEFT JOIN have USING (timeseries_id)
  UNION ALL SELECT timeseries_id, l + INTERVAL 1 MILLISECOND, TIMESTAMP '{B}', 'uncovered_tail' FROM have) WHERE start < "end"),
asked AS (SELECT * FROM (SELECT timeseries_id, greatest(start, TIMESTAMP '{B}' - INTERVAL 240 HOURS) AS start, "end" FROM cand) WHERE start < "end")"""


def _stitch(spark, d):
    o = observations(spark, d)
    primary = H.in_range(o, "2024-01-08", "2024-01-16").filter("timeseries_id <> 40")
    return primary, store_b(o), T.fill_slices(primary, o.select("timeseries_id").distinct(), A, B, 240)


@register("d23_fill_slices", f"WITH {STITCH} SELECT * FROM asked")
def _(spark, d):
    return _stitch(spark, d)[2][0]


@register("d23_skipped_slices", f"WITH {STITCH} SELECT timeseries_id, start, least(\"end\", TIMESTAMP '{B}' - INTERVAL 240 HOURS) AS \"end\", reason || '_outside_tail_cap' AS reason FROM cand WHERE start < TIMESTAMP '{B}' - INTERVAL 240 HOURS")
def _(spark, d):
    return _stitch(spark, d)[2][1]


STITCHED = f"""{STITCH}, p AS (SELECT timeseries_id, observed_at, max(value) AS value FROM prim GROUP BY ALL), s AS (SELECT b.timeseries_id, b.observed_at, max(value) AS value FROM store_b b JOIN asked q ON b.timeseries_id = q.timeseries_id AND b.observed_at >= q.start AND b.observed_at < q."end" GROUP BY ALL),
st AS (SELECT *, 'primary' AS source FROM p UNION ALL SELECT *, 'secondary' FROM s ANTI JOIN p USING (timeseries_id, observed_at))"""


@register("d23_stitched", f"WITH {STITCHED} SELECT * FROM st")
def _(spark, d):
    """U-03 and P-03 under it."""
    primary, secondary, (asked, _) = _stitch(spark, d)
    return T.stitched(primary, secondary, asked, A, B)


@register("t01_first_rows", f"WITH {STITCHED} SELECT * EXCLUDE (rn), total > 50 AS limited FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id ORDER BY observed_at) AS rn, count(*) OVER (PARTITION BY timeseries_id) AS total FROM st) WHERE rn <= 50")
def _(spark, d):
    primary, secondary, (asked, _) = _stitch(spark, d)
    return T.first_rows(T.stitched(primary, secondary, asked, A, B), 50)


@register("t02_last_rows", f"WITH {OBS} SELECT timeseries_id, observed_at, seq FROM obs ORDER BY observed_at DESC, connector_id DESC, station_id DESC, timeseries_id DESC, seq DESC LIMIT 100")
def _(spark, d):
    keys = ("observed_at", "connector_id", "station_id", "timeseries_id", "seq")
    return observations(spark, d).orderBy(*[F.desc(k) for k in keys]).limit(100).select("timeseries_id", "observed_at", "seq")


@register("t03_cursors", f"WITH {OBS} SELECT timeseries_id, observed_at, seq FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id ORDER BY observed_at DESC, seq DESC) AS rn FROM obs) WHERE rn = 1")
def _(spark, d):
    return T.cursors(observations(spark, d))


@register("d26_stable_head", f"""WITH {OBS}, {STORE_B}, s AS (SELECT timeseries_id, observed_at, max(value) AS s FROM obs WHERE observed_at < TIMESTAMP '2024-01-12' GROUP BY ALL), l AS (SELECT timeseries_id, observed_at, max(value) AS l FROM store_b WHERE observed_at >= TIMESTAMP '2024-01-08' GROUP BY ALL)
  SELECT coalesce(s.timeseries_id, l.timeseries_id) AS timeseries_id, count(*) FILTER (s IS NOT NULL AND l IS NOT NULL) AS overlap, count(*) FILTER (s <> l) AS mismatches, count(*) AS merged FROM s FULL JOIN l ON s.timeseries_id = l.timeseries_id AND s.observed_at = l.observed_at GROUP BY 1""")
def _(spark, d):
    o = observations(spark, d)
    one = lambda df: df.groupBy(*T.KEYS).agg(F.max("value").alias("value"))
    return T.stable_head(one(o.filter("observed_at < timestamp_ntz'2024-01-12'")), one(store_b(o).filter("observed_at >= timestamp_ntz'2024-01-08'")))


@register("d27_continuity", f"""WITH {OBS}, {MEMBERS}, j AS (SELECT o.*, m.timeseries_id AS member FROM obs o JOIN members m ON o.station_id = m.station_id AND o.timeseries_id = m.timeseries_id AND CAST(o.observed_at AS DATE) BETWEEN m.valid_from AND coalesce(m.valid_to, DATE '9999-12-31') WHERE value >= 0),
  h AS (SELECT station_id, date_trunc('hour', observed_at - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS hour, round(avg(value) + 1e-9, 6) AS hourly_mean, count(*) AS n FROM j GROUP BY ALL)
  SELECT h.*, m.timeseries_id AS member_id FROM h JOIN members m ON h.station_id = m.station_id AND CAST(h.hour - INTERVAL 1 MILLISECOND AS DATE) BETWEEN m.valid_from AND coalesce(m.valid_to, DATE '9999-12-31')""")
def _(spark, d):
    """Physical series read as one, hour-ending means, each hour given back to the member just before its end."""
    o = observations(spark, d)
    m = members(o)
    own = I.member_at(o.filter("value >= 0"), m, "station_id", "observed_at").filter("member_id = timeseries_id")
    hours = own.groupBy("station_id", hour_end("observed_at").alias("hour")).agg(F.round(F.avg("value") + 1e-9, 6).alias("hourly_mean"), F.count("*").alias("n"))
    return I.member_at(hours, m, "station_id", "hour", F.col("hour") - F.expr("INTERVAL 1 MILLISECOND"))


@register("d28_conflicts", f"WITH {OBS}, {STORE_B}, u AS (SELECT timeseries_id, observed_at, value, seq FROM obs UNION ALL SELECT timeseries_id, observed_at, value, seq + 1000000000 FROM store_b) SELECT timeseries_id, observed_at, arg_min(value, seq) AS value, count(DISTINCT value) > 1 AS conflict FROM u GROUP BY ALL")
def _(spark, d):
    o = observations(spark, d)
    c = ["timeseries_id", "observed_at", "value", "seq"]
    return T.conflicts(o.select(c).unionByName(store_b(o).withColumn("seq", F.col("seq") + 1_000_000_000).select(c)), T.KEYS, ["value"], "seq")


POLICY = "CASE WHEN pollutant_code NOT IN ('pm25', 'pm10', 'no2') THEN 'unsupported_pollutant' WHEN v IS NULL THEN 'missing_or_non_finite_value' WHEN v < 0 THEN 'negative_value' WHEN pollutant_code = 'pm25' AND v > 500 THEN 'above_pm25_maximum' WHEN pollutant_code = 'pm10' AND v > 600 THEN 'above_pm10_maximum' ELSE 'eligible' END"


@register("p06_value_policy", f"WITH {OBS} SELECT seq, {POLICY} AS reason FROM (SELECT *, CASE WHEN seq % 50 <> 0 THEN value * 2 - 20 END AS v FROM obs)")
def _(spark, d):
    v = F.when(F.col("seq") % 50 != 0, F.col("value") * 2 - 20)
    return observations(spark, d).select("seq", L.value_reason(F.upper("pollutant_code"), v).alias("reason"))


@register("p07_freshness", f"WITH {OBS} SELECT timeseries_id, count(*) AS n FROM obs WHERE observed_at >= TIMESTAMP '2024-01-20 10:33:00' - INTERVAL 6 HOURS GROUP BY ALL")
def _(spark, d):
    return L.fresh(observations(spark, d), "2024-01-20 10:33:41", "6 HOURS").groupBy("timeseries_id").agg(F.count("*").alias("n"))


@register("a29_f40_freshness_matrix", f"""WITH {OBS}, l AS (SELECT connector_id, pollutant_code, station_id, max(observed_at) AS t FROM obs WHERE observed_at < TIMESTAMP '2024-01-20' - INTERVAL 1 HOUR * (timeseries_id % 7) * 5 GROUP BY ALL),
  b AS (SELECT *, date_diff('second', t, TIMESTAMP '2024-01-20 00:00:00') AS s, CASE WHEN t >= TIMESTAMP '2024-01-19 21:00:00' THEN 'h3' WHEN t >= TIMESTAMP '2024-01-19 18:00:00' THEN 'h6' WHEN t >= TIMESTAMP '2024-01-19' THEN 'd1' WHEN t >= TIMESTAMP '2024-01-13' THEN 'd7' ELSE 'older' END AS a FROM l)
  SELECT connector_id, pollutant_code, count(*) FILTER (a = 'h3') AS h3, count(*) FILTER (a = 'h6') AS h6, count(*) FILTER (a = 'd1') AS d1, count(*) FILTER (a = 'd7') AS d7, count(*) FILTER (a = 'older') AS older FROM b GROUP BY ALL""")
def _(spark, d):
    o = observations(spark, d).filter("observed_at < timestamp_ntz'2024-01-20' - make_dt_interval(0, (timeseries_id % 7) * 5)")
    return L.freshness_matrix(o, "2024-01-20")


@register("a30_top_offenders", f"WITH {OBS} SELECT timeseries_id, count(*) AS n FROM obs GROUP BY ALL ORDER BY n DESC, timeseries_id LIMIT 5")
def _(spark, d):
    """T-06 too."""
    return observations(spark, d).groupBy("timeseries_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "timeseries_id").limit(5)


_BATCH = "batched AS (SELECT *, CAST(floor(seq / 2000) AS BIGINT) AS batch FROM obs)"


def _batched(spark, d):
    return observations(spark, d).withColumn("batch", F.floor(F.col("seq") / 2000))


@register("x03_latest_state", f"WITH {OBS}, {_BATCH} SELECT connector_id, timeseries_id, observed_at, value, seq FROM (SELECT *, row_number() OVER (PARTITION BY connector_id, timeseries_id ORDER BY observed_at DESC, batch DESC, seq) AS rn FROM batched) WHERE rn = 1")
def _(spark, d):
    return L.latest_state(_batched(spark, d)).select("connector_id", "timeseries_id", "observed_at", "value", "seq")


@register("x03_transitions", f"""WITH {OBS}, {_BATCH}, t AS (SELECT *, max({{'o': observed_at, 'b': batch}}) OVER (PARTITION BY connector_id, timeseries_id ORDER BY batch, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM batched)
  SELECT batch, CASE WHEN best IS NULL THEN 'applied_new' WHEN {{'o': observed_at, 'b': batch}} > best THEN 'applied_newer' WHEN {{'o': observed_at, 'b': batch}} = best THEN 'skipped_duplicate' ELSE 'skipped_older' END AS what, count(*) AS n FROM t GROUP BY ALL""")
def _(spark, d):
    b = _batched(spark, d)
    empty = L.latest_state(b).filter("false")
    return L.transitions(empty, b, "batch").groupBy("batch", "what").agg(F.count("*").alias("n"))


@register("x04_corrections", f"""WITH {OBS}, {STORE_B}, s AS (SELECT connector_id, timeseries_id, max(observed_at) AS o, arg_max(value, observed_at) AS v FROM (SELECT * FROM obs WHERE seq % 3 = 0) GROUP BY ALL), n AS (SELECT connector_id, timeseries_id, max(observed_at) AS o, arg_max(value, observed_at) AS v FROM (SELECT * FROM obs WHERE seq % 4 = 0 AND timeseries_id < 50) GROUP BY ALL),
  j AS (SELECT coalesce(s.connector_id, n.connector_id) AS connector_id, coalesce(s.timeseries_id, n.timeseries_id) AS timeseries_id, s.o AS so, s.v AS sv, n.o AS no, n.v AS nv, CASE WHEN n.o IS NULL THEN 'unchanged' WHEN s.o IS NULL THEN 'applied_new' WHEN n.o > s.o THEN 'applied_newer' WHEN n.o < s.o THEN 'skipped_older' WHEN n.v = s.v THEN 'skipped_equal' ELSE 'applied_same_timestamp_correction' END AS what FROM s FULL JOIN n ON s.connector_id = n.connector_id AND s.timeseries_id = n.timeseries_id)
  SELECT connector_id, timeseries_id, CASE WHEN what LIKE 'applied%' THEN no ELSE so END AS observed_at, CASE WHEN what LIKE 'applied%' THEN nv ELSE sv END AS value, what FROM j""")
def _(spark, d):
    o = observations(spark, d)
    one = lambda df: df.groupBy(*L.KEYS).agg(F.max("observed_at").alias("observed_at"), F.max_by("value", "observed_at").alias("value"))
    return L.corrected(one(o.filter("seq % 3 = 0")), one(o.filter("seq % 4 = 0 and timeseries_id < 50")))


@register("x02_f42_decoded", f"WITH {OBS} SELECT seq % 50 = 0 AS malformed, count(*) AS n, CAST(sum(CASE WHEN seq % 50 <> 0 THEN timeseries_id END) AS BIGINT) AS ids FROM obs GROUP BY ALL")
def _(spark, d):
    o = observations(spark, d)
    j = F.to_json(F.struct("connector_id", "timeseries_id", "observed_at", "value"))
    lines = o.select("seq", F.when(F.col("seq") % 50 == 0, F.substring(j, 1, 20)).otherwise(j).alias("value"))
    return L.decoded(lines).groupBy("malformed").agg(F.count("*").alias("n"), F.sum(F.when(~F.col("malformed"), F.col("timeseries_id"))).cast("long").alias("ids"))


OUTBOX = "outbox AS (SELECT o_orderkey AS id, CAST(o_orderkey % 22 AS INTEGER) AS attempts, CASE WHEN o_orderkey % 3 = 0 THEN 'old' END AS last_error, o_orderdate AS next_attempt_at, o_orderdate AS created_at FROM orders)"


def _outbox(spark, d):
    k = F.col("o_orderkey")
    at = F.col("o_orderdate").cast("timestamp_ntz")
    return table(spark, d, "orders").select(k.alias("id"), (k % 22).cast("int").alias("attempts"), F.when(k % 3 == 0, "old").alias("last_error"), at.alias("next_attempt_at"), at.alias("created_at"))


@register("x08_due_entries", f"WITH {OUTBOX} SELECT id, attempts FROM outbox WHERE next_attempt_at <= TIMESTAMP '1995-01-01' ORDER BY next_attempt_at, created_at, id LIMIT 200")
def _(spark, d):
    return L.due(_outbox(spark, d), "1995-01-01", 200).select("id", "attempts")


@register("x10_retry_policy", f"""WITH {OUTBOX}, r AS (SELECT id, id % 4 = 0 AS ok, CASE WHEN id % 5 = 0 THEN 'new' END AS error, CASE WHEN id % 7 = 0 THEN CAST(id % 5000 AS INTEGER) END AS retry FROM outbox WHERE id % 2 = 0)
  SELECT o.id, CASE WHEN ok IS NULL THEN attempts ELSE attempts + 1 END AS attempts, CASE WHEN ok IS NULL THEN last_error ELSE CASE WHEN attempts + 1 >= 20 THEN '[dead_letter_threshold_reached] ' ELSE '' END || coalesce(error, last_error, 'delivery failed') END AS last_error,
  CASE WHEN ok IS NULL THEN next_attempt_at ELSE TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (CASE WHEN attempts + 1 >= 20 THEN 3600 WHEN retry IS NOT NULL THEN greatest(0, least(retry, 3600)) WHEN attempts = 0 THEN 30 WHEN attempts = 1 THEN 120 WHEN attempts = 2 THEN 600 ELSE 3600 END) END AS next_attempt_at
  FROM outbox o LEFT JOIN r ON o.id = r.id WHERE NOT coalesce(ok, false)""")
def _(spark, d):
    o, i = _outbox(spark, d), F.col("id")
    r = o.filter("id % 2 = 0").select("id", (i % 4 == 0).alias("ok"), F.when(i % 5 == 0, "new").alias("error"), F.when(i % 7 == 0, (i % 5000).cast("int")).alias("retry_in_seconds"))
    return L.resolved(o, r, "2024-01-01")


@register("j02_d29_snapshot", f"""WITH {OBS}, {BINDINGS}, s AS (SELECT connector_id, timeseries_id, max(observed_at) AS observed_at, arg_max(value, {{'o': observed_at, 's': -seq}}) AS value FROM obs GROUP BY ALL)
  SELECT s.timeseries_id, s.observed_at, s.value, b.pollutant_code, n.n_name AS network FROM s LEFT JOIN bindings b ON s.timeseries_id = b.timeseries_id LEFT JOIN nation n ON s.connector_id = n.n_nationkey WHERE b.pollutant_code IN ('pm25', 'pm10', 'no2')""")
def _(spark, d):
    """P-08, J-03, J-04, X-06 and X-14's rules: state, left joins to dimensions, value policy."""
    o = observations(spark, d)
    s = L.latest_state(o.withColumn("batch", F.lit(0)))
    named = s.select("connector_id", "timeseries_id", "observed_at", "value").join(bindings(o).select("timeseries_id", "pollutant_code"), "timeseries_id", "left")
    named = named.join(table(spark, d, "nation").select(F.col("n_nationkey").alias("connector_id"), F.col("n_name").alias("network")), "connector_id", "left")
    return named.filter(L.value_reason(F.col("pollutant_code"), F.col("value")) == "eligible").select("timeseries_id", "observed_at", "value", "pollutant_code", "network")


@register("x09_outbox_flush", f"""WITH {OBS}, p AS (SELECT timeseries_id, observed_at, value, CAST(floor(seq / 100) AS BIGINT) AS entry, seq FROM obs), u AS (SELECT * FROM p UNION ALL SELECT timeseries_id, observed_at, value + 1, entry + 1000, seq FROM p WHERE seq % 11 = 0)
  SELECT timeseries_id, observed_at, value FROM (SELECT *, row_number() OVER (PARTITION BY timeseries_id, observed_at ORDER BY entry DESC, seq DESC) AS rn FROM u) WHERE rn = 1""")
def _(spark, d):
    """Payload arrays are packed (A-34), unpacked, and the last row of a key wins."""
    p = observations(spark, d).select("timeseries_id", "observed_at", "value", F.floor(F.col("seq") / 100).alias("entry"), "seq")
    u = p.unionByName(p.filter("seq % 11 = 0").withColumns({"value": F.col("value") + 1, "entry": F.col("entry") + 1000}))
    packed = u.groupBy("entry").agg(F.to_json(F.collect_list(F.struct("timeseries_id", "observed_at", "value", "seq")), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("payload"))
    rows = packed.select("entry", F.explode(F.from_json("payload", "array<struct<timeseries_id int, observed_at timestamp_ntz, value double, seq long>>")).alias("r")).select("entry", "r.*")
    return W.newest(rows, ["timeseries_id", "observed_at"], ["entry", "seq"]).select("timeseries_id", "observed_at", "value")


@register("x09_receipts", f"WITH {OBS} SELECT DISTINCT connector_id, timeseries_id, CAST(observed_at AS DATE) AS day FROM obs")
def _(spark, d):
    return observations(spark, d).select("connector_id", "timeseries_id", F.to_date("observed_at").alias("day")).dropDuplicates()
