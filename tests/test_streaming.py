"""Streams run to their end against the batch form."""

import json

import pytest
from pyspark.sql import functions as F

from chronoloom.plans.latest import latest_state
from chronoloom.streaming import keyed as K
from chronoloom.streaming import latest as L


def write(path, rows):
    path.write_text("\n".join(rows) + "\n")


def message(series, hour, value, seq=None):
    return json.dumps({"connector_id": 1, "timeseries_id": series, "observed_at": f"2024-01-01T{hour:02d}:00:00", "value": value, "seq": seq})


def values(state, batch=None):
    return {(r["timeseries_id"], r["value"]) for r in state.read(batch).collect()}


def test_latest_state_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.json", [message(1, 1, 1.0, 1), message(2, 5, 2.0, 2), '{"connector_id": 1, "timeser', message(1, 1, 9.0, 4)])
    state = K.LatestValues(spark, str(tmp_path / "state"))
    first = state.run(L.messages(spark, str(source), 1))
    assert values(state) == {(1, 1.0), (2, 2.0)}
    write(source / "b.json", [message(2, 4, 7.0, 1), message(1, 1, 3.0, 2), message(3, 0, 4.0, 3)])
    last = state.run(L.messages(spark, str(source), 1))
    assert last == first + 1
    # A later batch wins at an equal time; an older row does not.
    assert values(state) == {(1, 3.0), (2, 2.0), (3, 4.0)} and values(state, first) == {(1, 1.0), (2, 2.0)}
    dead = spark.read.parquet(str(tmp_path / "state" / "dead")).collect()
    assert [(r["raw"][:12], r["reason"]) for r in dead] == [('{"connector_', "not_json")]
    counts = {r["batch"]: tuple(r[w] for w in K.WHAT) for r in state.counts().collect()}
    assert counts == {first: (2, 0, 1, 0), last: (1, 1, 0, 1)}
    # What is read again replaces its own folders.
    rows = spark.read.schema(K.CHANGE).parquet(str(tmp_path / "state" / "changes" / f"batch={last}")).collect()
    state.write(spark.createDataFrame(rows, K.CHANGE), last)
    assert values(state) == {(1, 3.0), (2, 2.0), (3, 4.0)}
    state.fold()
    assert values(state) == {(1, 3.0), (2, 2.0), (3, 4.0)}
    write(source / "c.json", [message(3, 9, 5.0, 1)])
    state.run(L.messages(spark, str(source), 1))
    assert values(state) == {(1, 3.0), (2, 2.0), (3, 5.0)}


def test_a_small_batch_on_a_large_state_writes_its_keys_alone(spark, tmp_path):
    """100,000 keys, then 10 of them: the state store and the changes get 10 rows."""
    n = 100_000
    message_of = "to_json(named_struct('connector_id', 1, 'timeseries_id', cast(id + 1 as int), 'observed_at', '2024-01-0{}T00:00:00', 'value', {}))"
    spark.range(n).selectExpr(message_of.format(1, "cast(id as double)") + " as value").write.text(str(tmp_path / "in" / "n=0"))
    state = K.LatestValues(spark, str(tmp_path / "state"), most_keys=n)
    state.run(L.messages(spark, str(tmp_path / "in" / "n=*"), 1000))
    spark.range(10).selectExpr(message_of.format(2, "-1.0D") + " as value").write.text(str(tmp_path / "in" / "n=1"))
    batch = state.run(L.messages(spark, str(tmp_path / "in" / "n=*"), 1000))
    operator = state.progress[-1]["stateOperators"][0]
    assert operator["numRowsUpdated"] == 10 and operator["numRowsTotal"] == n
    assert spark.read.parquet(str(tmp_path / "state" / "changes" / f"batch={batch}")).count() == 10
    got = state.read()
    assert got.count() == n and got.filter("value = -1").count() == 10
    # The same rows as the batch form gives.
    lines = spark.read.text(str(tmp_path / "in" / "n=*")).select("value", F.lit(0).cast("long").alias("seq"))
    batch_form = latest_state(K.good_rows(lines).select(*K.KEYS, F.timestamp_micros("at").cast("timestamp_ntz").alias("observed_at"), "value", "seq", F.lit(0).alias("batch"))).select(got.columns)
    assert got.exceptAll(batch_form).isEmpty() and batch_form.exceptAll(got).isEmpty()
    # The store itself can be read as a table.
    store = spark.read.format("statestore").option("stateVarName", "latest").load(str(tmp_path / "state" / "checkpoint"))
    assert store.count() == n


def test_state_guard(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.json", [message(1, 1, 1.0), message(2, 1, 1.0)])
    state = K.LatestValues(spark, str(tmp_path / "state"), most_keys=1)
    with pytest.raises(Exception, match="2 keys"):
        state.run(L.messages(spark, str(source)))
    # Nothing counts as read: with a larger bound the batch is taken again.
    again = K.LatestValues(spark, str(tmp_path / "state"), most_keys=2)
    again.run(L.messages(spark, str(source)))
    assert values(again) == {(1, 1.0), (2, 1.0)} and [r["keys"] for r in again.counts().collect()] == [2]


def test_a_timer_takes_out_keys_that_no_row_renews(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    state = K.LatestValues(spark, str(tmp_path / "state"), retain="10 hours")
    for name, rows in (("a", [message(1, 0, 1.0), message(2, 5, 2.0)]), ("b", [message(2, 12, 3.0)]), ("c", [message(3, 23, 4.0)]), ("d", [message(1, 1, 9.0), message(3, 23, 5.0)])):
        write(source / f"{name}.json", rows)
        state.run(L.messages(spark, str(source), 1))
    # At 23 h the watermark is 13 h: series 1 and 2 end at 10 h and 22 h; the late row of series 1 is dropped.
    assert values(state) == {(2, 3.0), (3, 5.0)}
    assert state.counts().agg(F.sum("expired")).first()[0] == 1
    state.fold()
    assert values(state) == {(2, 3.0), (3, 5.0)}


def test_a_stream_goes_on_from_a_seed(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.json", [message(1, 2, 7.0), message(2, 1, 8.0)])
    seed = spark.createDataFrame([(1, 1, 1, 5.0), (1, 2, 3, 6.0), (1, 4, 1, 1.0)], "connector_id int, timeseries_id int, h int, value double").selectExpr("connector_id", "timeseries_id", "make_timestamp_ntz(2024, 1, 1, h, 0, 0) as observed_at", "value")
    state = K.LatestValues(spark, str(tmp_path / "state"), seed=seed)
    state.run(L.messages(spark, str(source)))
    assert values(state) == {(1, 7.0), (2, 6.0), (4, 1.0)}
    assert [(r["keys"], r["applied_newer"], r["skipped_older"]) for r in state.counts().collect()] == [(3, 1, 1)]


def test_seed_takes_the_latest_allowed_value(spark):
    rows = spark.createDataFrame([(1, 1, "pm25", 1, 5.0, 0), (1, 1, "pm25", 2, 900.0, 1), (1, 2, "o3", 1, 1.0, 2)], "connector_id int, timeseries_id int, pollutant_code string, h int, value double, seq long").selectExpr("*", "make_timestamp_ntz(2024, 1, 1, h, 0, 0) as observed_at")
    assert [(r["timeseries_id"], r["value"]) for r in L.seeded(rows).collect()] == [(1, 5.0)]
    assert latest_state(rows.selectExpr("*", "0L as batch")).count() == 2


def test_late_rows_are_told_apart(spark):
    rows = spark.createDataFrame([(0,), (30,)], "h int").selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h) as observed_at")
    now, old = L.late(rows, "2024-01-02")
    assert now.count() == 1 and str(old.first()["day"]) == "2024-01-01"


def test_run_without_new_input_returns_the_newest_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    state = K.LatestValues(spark, str(tmp_path / "state"))
    assert state.newest() == -1 and state.read().count() == 0
    write(source / "a.json", [message(1, 1, 1.0)])
    first = state.run(L.messages(spark, str(source)))
    assert state.run(L.messages(spark, str(source))) == first
    assert values(state) == {(1, 1.0)}


def test_bindings_keep_known_series_with_an_allowed_value(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    spark.createDataFrame([(1, "pm25"), (2, "unknown")], "timeseries_id int, pollutant_code string").write.parquet(str(tmp_path / "bindings"))
    state = K.LatestValues(spark, str(tmp_path / "state"), bindings=str(tmp_path / "bindings"))
    write(source / "a.json", [message(1, 1, 4.0), message(2, 1, 1.0), message(3, 1, 1.0), message(1, 2, -5.0)])
    state.run(L.messages(spark, str(source)))
    assert values(state) == {(1, 4.0)}


def test_hours_are_final_once_the_watermark_has_passed(spark, tmp_path):
    """Rows that come later than the delay change nothing, and open hours are not given yet."""
    source = tmp_path / "in"
    for n, rows in enumerate(([(0, 10.0), (1, 20.0)], [(200, 1.0)], [(201, 3.0)], [(0, 99.0), (202, 3.0)])):
        spark.createDataFrame(rows, "h int, value double").selectExpr("1 as connector_id", "7 as timeseries_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, h) as observed_at", "value").coalesce(1).write.mode("append").parquet(str(source / f"n={n}"))
    stream = spark.readStream.schema("connector_id int, timeseries_id int, observed_at timestamp_ntz, value double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
    got = L.drained(L.hourly(stream), str(tmp_path)).collect()
    assert sorted((r["hour"].isoformat(), r["hourly_mean"], r["sample_count"]) for r in got) == [("2024-01-01T00:00:00", 10.0, 1), ("2024-01-01T01:00:00", 20.0, 1)]


def test_reports_are_read_back(spark, tmp_path):
    from chronoloom.sources.files import write_report

    rows = spark.createDataFrame([("pm25", 1, 2.5), ("no2", 2, None)], "pollutant_code string, timeseries_id int, value double")
    write_report(rows, str(tmp_path / "tsv"), "\t")
    assert {tuple(r) for r in spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "tsv")).collect()} == {("pm25", "1", "2.5"), ("no2", "2", None)}


def test_rows_of_a_key_reach_the_state_packed(spark, tmp_path):
    """6,000 messages of three keys are a few rows for the state; counts are those of a loop over messages."""
    import random

    rng = random.Random(3)
    rows = [(rng.randint(1, 3), rng.randint(0, 23), rng.choice((None, 1.0, 2.0)), i) for i in range(6000)]
    rng.shuffle(rows)
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.json", [message(*r) for r in rows])
    lines = spark.read.text(str(tmp_path / "in"))
    few = K.packed(K.good_rows(lines)).collect()
    assert len(few) <= 3 * lines.rdd.getNumPartitions() and sum(len(r["times"]) for r in few) == 8 * 6000
    assert K.packed(K.good_rows(lines), together=False).count() == 6000
    state = K.LatestValues(spark, str(tmp_path / "state"))
    batch = state.run(L.messages(spark, str(tmp_path / "in"), 1))
    want, best = dict.fromkeys(K.WHAT, 0), {}
    for series, hour, value, seq in sorted(rows, key=lambda r: r[3]):
        was = best.get(series)
        want["applied_new" if was is None else "applied_newer" if hour > was[0] else "skipped_duplicate" if hour == was[0] else "skipped_older"] += 1
        if was is None or hour > was[0]:
            best[series] = (hour, value)
    assert {w: r[w] for r in state.counts().collect() if r["batch"] == batch for w in K.WHAT} == want
    assert values(state) == {(k, v) for k, (_, v) in best.items()}
