"""Tree fingerprints, comparison by descent, canonical rows and their hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.catalog.reconcile import TEXT
from chronoloom.functions import text as X
from chronoloom.plans import reconcile as R
from chronoloom.plans import trees as T
from chronoloom.sources.fixtures import OBS, STORE_B, observations, store_b

KEYS, DEPTH = ["connector_id", "day"], 2


def _tree_sql(source: str, name: str) -> str:
    """The same tree of two levels below the root."""
    node = lambda size, child: f"SELECT connector_id, day, substr(prefix, 1, {size}) AS prefix, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(substr(prefix, {size + 1}, 1) || ':' || hash, chr(10) ORDER BY prefix)) AS hash FROM {child} GROUP BY connector_id, day, substr(prefix, 1, {size})"
    return f"""{name}h AS (SELECT connector_id, CAST(observed_at AS DATE) AS day, sha256({TEXT}) AS h, count(*) AS c FROM {source} GROUP BY ALL),
{name}2 AS (SELECT connector_id, day, substr(h, 1, 2) AS prefix, CAST(sum(c) AS BIGINT) AS n, sha256(string_agg(h || ':' || c, chr(10) ORDER BY h || ':' || c)) AS hash FROM {name}h GROUP BY ALL),
{name}1 AS ({node(1, name + "2")}), {name}0 AS ({node(0, name + "1")})"""


def _days(rows):
    return rows.withColumn("day", F.to_date("observed_at"))


@register("a08_tree_nodes", f"WITH {OBS}, {_tree_sql('obs', 'a')} SELECT *, 0 AS level FROM a0 UNION ALL SELECT *, 1 FROM a1 UNION ALL SELECT *, 2 FROM a2")
def _(spark, d):
    """Leaves by the first two digits of row hashes, hashed in parallel, and the nodes above them."""
    return T.tree(_days(observations(spark, d)), KEYS, DEPTH)


@register("a14_tree_roll_up", f"WITH {OBS}, {_tree_sql('obs', 'a')}, r AS (SELECT connector_id, day, n, sha256('observations/2' || chr(10) || hash) AS fingerprint FROM a0) SELECT CAST(year(day) AS INTEGER) AS y, CAST(month(day) AS INTEGER) AS m, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(fingerprint, chr(10) ORDER BY day, connector_id)) AS fingerprint FROM r GROUP BY ALL")
def _(spark, d):
    """Months over the roots of days and sources."""
    roots = T.roots(_days(observations(spark, d)), KEYS, DEPTH, "observations/2\n")
    return R.rolled_up(roots.withColumns({"y": F.year("day"), "m": F.month("day")}), ["y", "m"], ["day", "connector_id"])


COUNTED = "SELECT connector_id, CAST(observed_at AS DATE) AS day, timeseries_id, observed_at, value, count(*) AS n FROM"


@register("d10_tree_differences", f"""WITH {OBS}, {STORE_B}, x AS ({COUNTED} obs GROUP BY ALL), y AS ({COUNTED} store_b GROUP BY ALL),
  j AS (SELECT coalesce(x.connector_id, y.connector_id) AS connector_id, coalesce(x.day, y.day) AS day, coalesce(x.timeseries_id, y.timeseries_id) AS timeseries_id, coalesce(x.observed_at, y.observed_at) AS observed_at, coalesce(x.value, y.value) AS value, coalesce(x.n, 0) AS n_a, coalesce(y.n, 0) AS n_b FROM x FULL JOIN y USING (connector_id, day, timeseries_id, observed_at, value))
  SELECT *, CASE WHEN n_b = 0 THEN 'missing_in_b' WHEN n_a = 0 THEN 'extra_in_b' ELSE 'count_differs' END AS result FROM j WHERE n_a <> n_b""")
def _(spark, d):
    """Rows that two stores hold unlike, found by going down two trees; rows of equal leaves are not compared."""
    a = _days(observations(spark, d))
    b = _days(store_b(observations(spark, d)))
    found = T.differing_leaves(T.tree(a, KEYS, DEPTH), T.tree(b, KEYS, DEPTH), KEYS, DEPTH)
    return T.differing_rows(a, b, found, KEYS, DEPTH)


@register("a10_source_identity", f"""WITH {OBS}, {STORE_B}, {_tree_sql('obs', 'a')}, {_tree_sql('store_b', 'b')}, q AS (SELECT * FROM b0 WHERE day(day) <> 7),
  j AS (SELECT coalesce(a.connector_id, b.connector_id) AS connector_id, coalesce(a.day, b.day) AS day, a.n AS n_now, b.n AS n_before, a.hash AS fa, b.hash AS fb FROM (SELECT * FROM a0 WHERE day(day) <> 8) a FULL JOIN q b ON a.connector_id = b.connector_id AND a.day = b.day)
  SELECT connector_id, day, n_now, n_before, CASE WHEN fb IS NULL THEN 'new' WHEN fa IS NULL THEN 'gone' WHEN fa = fb THEN 'same' WHEN n_now = n_before THEN 'changed_with_equal_count' ELSE 'changed' END AS state FROM j""")
def _(spark, d):
    """Identities of a source's days, as they were kept and as they are."""
    now = T.roots(_days(observations(spark, d)), KEYS, DEPTH).filter(F.day("day") != 8)
    before = T.roots(_days(store_b(observations(spark, d))), KEYS, DEPTH).filter(F.day("day") != 7)
    return T.identity_states(now, before, KEYS)


BITS = "printf('%016x', CAST(CAST(value + 0.0 AS BIT) AS BIGINT))"
CANONICAL = f"""'[' || connector_id || ',' || CASE WHEN seq % 7 = 0 THEN 'null' ELSE CAST(station_id AS VARCHAR) END || ',' || timeseries_id || ',"' || pollutant_code || '","' || strftime(date_trunc('millisecond', observed_at), '%Y-%m-%dT%H:%M:%S.%g') || 'Z","' || {BITS} || '",' || CASE WHEN seq % 2 = 0 THEN '"P"' WHEN seq % 3 = 0 THEN '"R"' ELSE 'null' END || ']'"""


def canonical(spark, d):
    o = observations(spark, d)
    station = F.when(F.col("seq") % 7 != 0, F.col("station_id"))
    status = F.when(F.col("seq") % 2 == 0, "P").when(F.col("seq") % 3 == 0, "R")
    at = F.date_trunc("millisecond", "observed_at").cast("timestamp_ntz")
    return o.withColumns({"status": status, "encoded": X.canonical_row(F.col("connector_id"), station, F.col("timeseries_id"), F.col("pollutant_code"), at, F.col("value"), status)})


@register("f32_canonical_texts", f"WITH {OBS} SELECT seq, {CANONICAL} AS encoded FROM obs")
def _(spark, d):
    """Whole rows in their canonical form, the value's bits included."""
    return canonical(spark, d).select("seq", "encoded")


@register("f33_value_bits", f"WITH {OBS} SELECT seq, {BITS.replace('value', '(value - 100) * 1e-3')} AS bits, (value - 100) * 1e-3 + 0.0 AS value FROM obs")
def _(spark, d):
    v = (F.col("value") - 100) * 1e-3
    bits = observations(spark, d).select("seq", X.float_bits(v).alias("bits"))
    return bits.withColumn("value", X.bits_float(F.col("bits")))


@register("a09_content_hash", f"""WITH {OBS}, e AS (SELECT connector_id, CAST(observed_at AS DATE) AS day, seq, {CANONICAL} AS encoded FROM obs)
  SELECT connector_id, day, count(*) AS n, count(*) FILTER (seq % 2 = 0) AS p, count(*) FILTER (seq % 2 <> 0 AND seq % 3 = 0) AS r, count(*) FILTER (seq % 2 <> 0 AND seq % 3 <> 0) AS without, sha256('content/1' || chr(10) || string_agg(encoded || chr(10), '' ORDER BY encoded)) AS fingerprint FROM e GROUP BY ALL""")
def _(spark, d):
    """The hash of a partition's canonical rows in order, with how many have each status."""
    return R.content_hashes(canonical(spark, d).withColumn("day", F.to_date("observed_at")), ["connector_id", "day"], "encoded", "status", "content/1\n")
