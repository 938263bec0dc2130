"""Streaming queries, run until their input is read, and history written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.catalog import register
from chronoloom.catalog.levels import rounded
from chronoloom.sources import fixtures, skipping
from chronoloom.sources.commits import Versioned
from chronoloom.sources.files import partition_value, read_history, write_history, write_report
from chronoloom.sources.fixtures import OBS, observations, store_b
from chronoloom.sources.shared import scratch
from chronoloom.streaming import keyed
from chronoloom.streaming import latest as L

MESSAGE = ("connector_id", "timeseries_id", "observed_at", "value")
HISTORY = "timeseries_id int, station_id int, observed_at timestamp_ntz, value double, seq long, day_utc date, connector_id int, pollutant_code string"


def _stream(spark, d):
    """events as a stream of observations."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return fixtures.as_observations(events)


def _lines(rows):
    """Messages as JSON lines, every fiftieth cut off."""
    j = F.to_json(F.struct(*MESSAGE, "seq"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return rows.select(F.when(F.col("seq") % 50 == 0, F.substring(j, 1, 20)).otherwise(j).alias("value"))


@register("x12_hourly_stream", f"WITH {OBS} SELECT connector_id, timeseries_id, date_trunc('hour', observed_at) AS hour, round(avg(value) + 1e-9, 6) AS hourly_mean, count(value) AS sample_count FROM obs WHERE date_trunc('hour', observed_at) + INTERVAL 1 HOUR <= (SELECT max(observed_at) FROM obs) - INTERVAL 120 HOURS GROUP BY ALL")
def _(spark, d):
    """Hours that can no longer change: the watermark has passed them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return rounded(L.drained(L.hourly(_stream(spark, d)), scratch(spark, "hours")), "hourly_mean")


_LAST = "SELECT connector_id, timeseries_id, observed_at, value FROM (SELECT *, row_number() OVER (PARTITION BY connector_id, timeseries_id ORDER BY observed_at DESC, seq) AS rn FROM obs WHERE seq % 50 <> 0) WHERE rn = 1"


@register("x01_streamed_latest_state", f"WITH {OBS} {_LAST}")
def _(spark, d):
    """X-02, X-05 and X-07 too: messages to keyed state, malformed ones aside with their reason, a bound on keys."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    state = keyed.LatestValues(spark, scratch(spark, "state"))
    state.run(_lines(_stream(spark, d)))
    return state.read()


BATCH = "b AS (SELECT *, CAST(floor(seq * 3 / (SELECT max(seq) + 1 FROM obs)) AS BIGINT) AS batch FROM obs)"


def _keyed(spark, d):
    """Three runs over one checkpoint, each with the messages of a third of the rows; the state goes on from run to run,
    changes of the first two are folded into a base."""
    rows = observations(spark, d)
    third = rows.withColumn("batch", F.floor(F.col("seq") * 3 / (rows.agg(F.max("seq")).first()[0] + 1)))
    source, state = scratch(spark, "messages"), keyed.LatestValues(spark, scratch(spark, "state"))
    for batch in range(3):
        _lines(third.filter(F.col("batch") == batch)).write.mode("append").text(f"{source}/n={batch}")
        state.run(L.messages(spark, f"{source}/n=*", 1000))
        if batch == 1:
            state.fold()
    return state


@register("x03_keyed_state", f"WITH {OBS} {_LAST}")
def _(spark, d):
    """X-14 too: a state that is carried from run to run."""
    return _keyed(spark, d).read()


@register("x03_keyed_counts", f"""WITH {OBS}, {BATCH}, t AS (SELECT *, max({{'o': observed_at, 'b': batch}}) OVER (PARTITION BY connector_id, timeseries_id ORDER BY batch, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM b WHERE seq % 50 <> 0),
  c AS (SELECT batch, count(*) FILTER (best IS NULL) AS applied_new, count(*) FILTER ({{'o': observed_at, 'b': batch}} > best) AS applied_newer, count(*) FILTER ({{'o': observed_at, 'b': batch}} = best) AS skipped_duplicate, count(*) FILTER ({{'o': observed_at, 'b': batch}} < best) AS skipped_older FROM t GROUP BY ALL)
  SELECT *, CAST(sum(applied_new) OVER (ORDER BY batch) AS BIGINT) AS keys FROM c""")
def _(spark, d):
    """What the rows of each batch did, and keys in the state after it."""
    return _keyed(spark, d).counts().select("batch", "keys", *keyed.WHAT)


ELIGIBLE = "pollutant_code IN ('pm25', 'pm10', 'no2') AND value >= 0"


@register("x06_refreshed_metadata", f"""WITH {OBS}, {BATCH}, k AS (SELECT * FROM b WHERE seq % 50 <> 0 AND {ELIGIBLE} AND (batch = 0 AND timeseries_id <> 10 OR batch = 1 AND timeseries_id <> 21))
  SELECT connector_id, timeseries_id, observed_at, value FROM (SELECT *, row_number() OVER (PARTITION BY connector_id, timeseries_id ORDER BY observed_at DESC, batch DESC, seq) AS rn FROM k) WHERE rn = 1""")
def _(spark, d):
    """Messages meet the metadata that is stored when a run starts: a series that was unknown to the first run is taken by
    the second, and one that has gone by then is not; the value policy holds for both."""
    rows = observations(spark, d)
    third = rows.withColumn("batch", F.floor(F.col("seq") * 3 / (rows.agg(F.max("seq")).first()[0] + 1)))
    source, known = scratch(spark, "messages"), scratch(spark, "bindings")
    state = keyed.LatestValues(spark, scratch(spark, "state"), bindings=known)
    for batch, unknown in enumerate((10, 21)):
        fixtures.bindings(rows, unknown).write.mode("overwrite").parquet(known)
        _lines(third.filter(F.col("batch") == batch)).write.text(f"{source}/n={batch}")
        state.run(L.messages(spark, f"{source}/n=*", 1000))
    return state.read()


@register("s22_reports", f"WITH {OBS} SELECT pollutant_code, timeseries_id, count(*) AS n, min(observed_at) AS first, round(sum(value) + 1e-9, 6) AS total FROM obs GROUP BY ALL")
def _(spark, d):
    """A report as tab-separated text, with names of columns, read again."""
    path = scratch(spark, "report")
    rows = observations(spark, d).groupBy("pollutant_code", "timeseries_id").agg(F.count("*").alias("n"), F.min("observed_at").alias("first"), F.round(F.sum("value") + 1e-9, 6).alias("total"))
    write_report(rows.withColumn("first", F.date_format("first", "yyyy-MM-dd HH:mm:ss.SSSSSS")), path, "\t")
    return spark.read.option("header", True).option("sep", "\t").schema("pollutant_code string, timeseries_id int, n long, first timestamp_ntz, total double").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


@register("s21_published_snapshots", f"WITH {OBS}, s AS (SELECT pollutant_code, timeseries_id, max(observed_at) AS observed_at, arg_max(value, {{'o': observed_at, 's': -seq}}) AS value FROM obs GROUP BY ALL) SELECT * FROM s WHERE pollutant_code <> 'temperature'")
def _(spark, d):
    """Published twice: all measures, then with one that is gone and others as they were, of which nothing is written."""
    o = observations(spark, d)
    rows = o.groupBy("pollutant_code", "timeseries_id").agg(F.max(F.struct("observed_at", (-F.col("seq")).alias("s"), "value")).alias("r")).select("pollutant_code", "timeseries_id", "r.observed_at", "r.value")
    table = Versioned(spark, scratch(spark, "snapshots"), L.SNAPSHOT, "json")
    L.publish_snapshots(rows, table)
    done = L.publish_snapshots(rows.filter("pollutant_code <> 'temperature'"), table)
    assert set(done) == {"skip", "delete"}, done
    return table.read().select("pollutant_code", "timeseries_id", "observed_at", "value")


@register("s21_snapshot_cursors", f"WITH {OBS} SELECT pollutant_code, count(*) AS n, min(observed_at) AS first, max(observed_at) AS last, max(observed_at) AS next_since, CAST(arg_max(timeseries_id, {{'o': observed_at, 't': timeseries_id}}) AS INTEGER) AS next_since_id FROM obs GROUP BY ALL")
def _(spark, d):
    return L.snapshot_cursors(observations(spark, d))


#: (application, data) -> root of a history and of its index, which several queries read.
_ROOTS: dict = {}


def _written(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _ROOTS:
        root, at = scratch(spark, "history"), scratch(spark, "index")
        write_history(observations(spark, d), root)
        skipping.write_index(skipping.file_index(read_history(spark, root, HISTORY)), at)
        _ROOTS[key] = root, at
    return _ROOTS[key]


@register("s13_s17_history_round_trip", f"WITH {OBS} SELECT pollutant_code, CAST(observed_at AS DATE) AS day, count(*) AS n, min(observed_at) AS first, max(observed_at) AS last FROM obs GROUP BY ALL")
def _(spark, d):
    """S-01 and S-02 too: written by day, source and measure, read again with the path's values."""
    back = read_history(spark, _written(spark, d)[0], HISTORY)
    return back.groupBy(partition_value("pollutant_code").alias("pollutant_code"), partition_value("day_utc").cast("date").alias("day")).agg(F.count("*").alias("n"), F.min("observed_at").alias("first"), F.max("observed_at").alias("last"))


def _indexed(spark, d):
    """A history and its index, both as tables."""
    root, at = _written(spark, d)
    return root, skipping.read_index(spark, at)


PART = "CAST(observed_at AS DATE) AS day_utc, connector_id, pollutant_code"


@register("a16_a23_file_statistics", f"WITH {OBS} SELECT {PART}, timeseries_id, count(*) AS n, min(observed_at) AS first, max(observed_at) AS last FROM obs GROUP BY ALL")
def _(spark, d):
    """Rows of each file and series, told by the values of the file's partition; here each series of a day is in one file."""
    return _indexed(spark, d)[1].drop("file")


@register("a23_rows_by_partition", f"WITH {OBS} SELECT {PART}, count(*) AS n FROM obs GROUP BY ALL")
def _(spark, d):
    return _indexed(spark, d)[1].groupBy("day_utc", "connector_id", "pollutant_code").agg(F.sum("n").alias("n"))


A, B = "2024-01-08 06:00:00", "2024-01-11 18:30:00"
ASKED = [10, 21, 40]


@register("s03_pruned_series", f"WITH {OBS} SELECT timeseries_id, observed_at, value, seq FROM obs WHERE timeseries_id = 21 AND observed_at >= TIMESTAMP '{A}' AND observed_at < TIMESTAMP '{B}'")
def _(spark, d):
    """One series in a range of hours: the index is asked, the files that it names are read."""
    root, index = _indexed(spark, d)
    wanted = skipping.asked(spark, [21], A, B)
    return skipping.wanted_rows(spark, root, skipping.files_to_read(index, wanted), wanted, HISTORY).select("timeseries_id", "observed_at", "value", "seq")


@register("s04_files_opened", f"WITH {OBS}, f AS (SELECT {PART}, timeseries_id, min(observed_at) AS a, max(observed_at) AS b FROM obs GROUP BY ALL) SELECT DISTINCT day_utc, connector_id, pollutant_code FROM f WHERE timeseries_id IN (10, 21, 40) AND b >= TIMESTAMP '{A}' AND a < TIMESTAMP '{B}'")
def _(spark, d):
    """Many series: the partitions of the files that the scan opens, from the scan itself."""
    root, index = _indexed(spark, d)
    opened = skipping.read_files(spark, root, skipping.files_to_read(index, skipping.asked(spark, ASKED, A, B)), HISTORY).inputFiles()
    names = spark.createDataFrame([(f,) for f in opened], "file string")
    return names.select(partition_value("day_utc").cast("date").alias("day_utc"), partition_value("connector_id").cast("int").alias("connector_id"), partition_value("pollutant_code").alias("pollutant_code")).distinct()


@register("s12_rows_by_manifest", f"WITH {OBS} SELECT timeseries_id, observed_at, value, seq FROM obs WHERE timeseries_id IN (10, 21, 40) AND observed_at >= TIMESTAMP '{A}' AND observed_at < TIMESTAMP '{B}'")
def _(spark, d):
    """Manifests as JSON documents name ranges of ids and times; J-21's tiles find the files."""
    root, index = _indexed(spark, d)
    manifests = scratch(spark, "manifests")
    skipping.write_manifests(index, manifests)
    wanted = skipping.asked(spark, ASKED, A, B)
    return skipping.wanted_rows(spark, root, skipping.files_by_manifest(spark, manifests, wanted), wanted, HISTORY).select("timeseries_id", "observed_at", "value", "seq")


@register("s19_committed_versions", f"WITH {OBS}, {fixtures.STORE_B} SELECT connector_id, CAST(observed_at AS DATE) AS day, timeseries_id, observed_at, value FROM store_b WHERE day(observed_at) <> 9")
def _(spark, d):
    """Two versions: the first store's rows, then the other's without a day, of which only partitions that differ are written
    and those that are gone leave the table."""
    from chronoloom.plans import trees

    keys, table = ["connector_id", "day"], None
    table = Versioned(spark, scratch(spark, "versions"), keys)
    first = observations(spark, d).withColumn("day", F.to_date("observed_at")).select(*keys, "timeseries_id", "observed_at", "value")
    second = store_b(observations(spark, d)).withColumn("day", F.to_date("observed_at")).select(*first.columns).filter(F.day("day") != 9)
    depth = trees.depth_for(first, second, keys=keys)
    for rows in (first, second):
        table.publish(rows, trees.roots(rows, keys, depth).withColumnRenamed("fingerprint", "hash"))
    return table.read().select(*first.columns)
