"""Boundary cases of the index, guideline, window, stitching, state and text rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.functions import time as Z
from chronoloom.operators import geo, hourly, intervals, levels, sets, windows
from chronoloom.plans import guideline, index_levels, latest, reconcile, stitch
from chronoloom.sources import files

T0 = dt.datetime(2024, 3, 1)
OBS = "connector_id int, station_id int, timeseries_id int, pollutant_code string, observed_at timestamp_ntz, value double, seq long"


def obs(spark, hours, measure="pm25", series=1, value=20.0, start=T0):
    return spark.createDataFrame([(1, 1, series, measure, start + dt.timedelta(hours=h), value, i) for i, h in enumerate(hours)], OBS)


def test_eighteen_of_twenty_four_hours(spark):
    for n, want in ((18, "ok"), (17, "insufficient_samples")):
        rows = index_levels.from_observations(obs(spark, range(24 - n, 24))).orderBy(F.desc("hour")).first()
        assert (rows["daqi_status"], rows["daqi_count"]) == (want, n)
        assert rows["daqi_level"] == (2 if want == "ok" else None) and rows["eaqi_level"] == 3


def test_gaps_are_filled_inside_the_series_only(spark):
    out = index_levels.from_observations(obs(spark, [h for h in range(46) if h not in (30, 31)]))
    hours = {r["hour"] for r in out.collect()}
    assert max(hours) == T0 + dt.timedelta(hours=45) and T0 + dt.timedelta(hours=30) in hours
    synthetic = out.filter("hourly_sample_count is null").collect()
    assert len(synthetic) == 2 and all(r["eaqi_status"] == "missing_input" for r in synthetic)


def test_gases_use_the_hour_and_are_not_filled(spark):
    out = index_levels.from_observations(obs(spark, [0, 5], "no2", value=67.0)).collect()
    assert len(out) == 2 and all((r["daqi_level"], r["daqi_averaging"]) == (1, "hourly_mean") for r in out)


def test_bands_include_their_upper_end(spark):
    v = spark.createDataFrame([(x,) for x in (-0.1, 0.0, 11.0, 11.01, 70.0, 70.01, None, float("nan"))], "v double")
    got = [r[0] for r in v.select(levels.level("daqi", F.col("v"), F.lit("pm25"))).collect()]
    assert got == [None, 1, 1, 2, 9, 10, None, None]


def test_last_row_wins_whatever_the_order(spark):
    rows = [(1, 1, 1, "pm25", T0, float(v), v) for v in (3, 1, 2)]
    for order in (rows, rows[::-1]):
        assert hourly.last_wins(spark.createDataFrame(order, OBS)).first()["value"] == 3.0


def test_hour_conventions_at_full_hours(spark):
    t = spark.createDataFrame([(T0,), (T0 + dt.timedelta(minutes=1),)], "t timestamp_ntz")
    got = [tuple(r) for r in t.select(Z.hour_start("t"), Z.hour_end("t"), Z.closed_day("t")).collect()]
    assert got[0] == (T0, T0, dt.date(2024, 2, 29))
    assert got[1] == (T0, T0 + dt.timedelta(hours=1), dt.date(2024, 3, 1))


def test_midnight_belongs_to_the_day_before_as_an_hour_of_its_own(spark):
    days = {r["day"]: r for r in guideline.daily_means(obs(spark, range(1, 25))).collect()}
    assert set(days) == {T0.date()} and days[T0.date()]["valid_hours"] == 24
    few = guideline.daily_means(obs(spark, range(1, 18))).first()
    assert (few["valid_hours"], few["daily_mean"]) == (17, None)
    bad = guideline.daily_means(obs(spark, [1, 2], value=-1.0)).first()
    assert (bad["valid_hours"], bad["daily_mean"]) == (0, None)


def test_calendar_year_thresholds(spark):
    days = guideline.daily_means(obs(spark, range(1, 24 * 20 + 1)))
    got = guideline.calendar_year(days, "2024-03-20").first()
    assert (got["kind"], got["period_days"], got["min_days"], got["has_enough_data"]) == ("year_to_date", 80, 60, False)


def test_fingerprints_do_not_depend_on_row_order(spark):
    rows = obs(spark, range(5))
    one = reconcile.hour_buckets(rows).select("hour", "fingerprint")
    two = reconcile.hour_buckets(rows.orderBy(F.desc("seq")).repartition(3)).select("hour", "fingerprint")
    assert one.exceptAll(two).isEmpty() and reconcile.hour_buckets(rows.withColumn("value", F.lit(-0.0))).select("fingerprint").exceptAll(reconcile.hour_buckets(rows.withColumn("value", F.lit(0.0))).select("fingerprint")).isEmpty()


def test_time_gaps_use_the_upper_median(spark):
    rows = obs(spark, [0, 1, 2, 3, 6, 7])
    got = {(r["start"], r["end"]) for r in windows.time_gaps(rows, "2024-03-01", "2024-03-01 08:00:00", 3600).collect()}
    assert got == {(T0 + dt.timedelta(hours=3), T0 + dt.timedelta(hours=6))}
    assert windows.time_gaps(obs(spark, [0]), "2024-02-01", "2024-04-01", 900).count() == 0


def test_touching_intervals_merge(spark):
    h = lambda n: T0 + dt.timedelta(hours=n)
    rows = spark.createDataFrame([(1, h(0), h(5)), (1, h(1), h(2)), (1, h(5), h(6)), (1, h(8), h(9)), (1, h(9), h(9))], "k int, start timestamp_ntz, end timestamp_ntz")
    assert sorted((r["start"], r["end"]) for r in windows.merged_intervals(rows, ["k"]).collect()) == [(h(0), h(6)), (h(8), h(9))]


def test_members_with_open_ends(spark):
    m = spark.createDataFrame([(1, 10, dt.date(2024, 1, 1), dt.date(2024, 3, 1)), (1, 11, dt.date(2024, 3, 2), None)], "station_id int, timeseries_id int, valid_from date, valid_to date")
    got = [r["member_id"] for r in intervals.member_at(obs(spark, [0, 23, 24, 9999]), m, "station_id", "observed_at").orderBy("seq").collect()]
    assert got == [10, 10, 11, 11]
    assert windows.interval_faults(m, "station_id").first()["valid"]
    assert not windows.interval_faults(m.withColumn("valid_to", F.lit(None).cast("date")), "station_id").first()["valid"]


def test_precedence_and_multisets(spark):
    a, b = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string"), spark.createDataFrame([(2, "b"), (3, "b"), (3, "b")], "k int, v string")
    assert sorted(tuple(r) for r in sets.prefer(a, b.distinct(), ["k"]).collect()) == [(1, "a"), (2, "a"), (3, "b")]
    got = {r["k"]: (r["matched"], r["missing"], r["unexpected"]) for r in sets.multiset_difference(a.select("k"), b.select("k"), ["k"]).collect()}
    assert got == {1: (0, 1, 0), 2: (1, 0, 0), 3: (0, 0, 2)}


def test_fill_slices_are_capped(spark):
    asked, skipped = stitch.fill_slices(obs(spark, [10, 20]), spark.createDataFrame([(1,), (2,)], "timeseries_id int"), "2024-03-01", "2024-03-02", 12)
    h = lambda n: T0 + dt.timedelta(hours=n)
    assert {(r["timeseries_id"], r["start"]) for r in asked.collect()} == {(1, h(20) + dt.timedelta(milliseconds=1)), (2, h(12))}
    assert {(r["timeseries_id"], r["end"], r["reason"]) for r in skipped.collect()} == {(1, h(10), "uncovered_head_outside_tail_cap"), (2, h(12), "empty_window_outside_tail_cap")}


def test_equal_times_within_and_across_batches(spark):
    rows = spark.createDataFrame([(1, 1, T0, 1.0, 0, 0), (1, 1, T0, 2.0, 0, 1), (1, 1, T0, 3.0, 1, 0), (1, 1, T0 - dt.timedelta(hours=1), 4.0, 2, 0)], "connector_id int, timeseries_id int, observed_at timestamp_ntz, value double, batch long, seq long")
    assert latest.latest_state(rows.filter("batch = 0")).first()["value"] == 1.0
    assert latest.latest_state(rows).first()["value"] == 3.0
    got = [r["what"] for r in latest.transitions(latest.latest_state(rows).filter("false"), rows, "batch").orderBy("batch", "seq").collect()]
    assert got == ["applied_new", "skipped_duplicate", "applied_newer", "skipped_older"]


def test_value_policy(spark):
    rows = spark.createDataFrame([("PM2.5", 500.0), ("pm25", 500.1), ("pm_10", 600.1), ("no2", -0.1), ("o3", 1.0), ("no2", None), ("no2", float("nan"))], "m string, v double")
    got = [r[0] for r in rows.select(latest.value_reason(F.col("m"), F.col("v"))).collect()]
    assert got == ["eligible", "above_pm25_maximum", "above_pm10_maximum", "negative_value", "unsupported_pollutant", "missing_or_non_finite_value", "missing_or_non_finite_value"]


def one(spark, column, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


def test_postcodes(spark):
    for raw, want in ((" sw1a 1aa ", "SW1A1AA"), ("GIR 0AA", "GIR0AA"), ("m1-1ae", "M11AE"), ("12345", None), ("SW1A", None), ("", None)):
        assert one(spark, X.postcode, raw) == want
    assert one(spark, X.postcode_display, "SW1A1AA") == "SW1A 1AA" and one(spark, X.postcode_outward, "M11AE") == "M1" and one(spark, X.postcode_shard, "SW1A1AA") == "SW"


def test_labels_and_units(spark):
    assert one(spark, X.unit, " ug.m-3 ") == "µg/m³" and one(spark, X.unit, "ppb") == "ppb" and one(spark, X.unit, " ") is None
    assert one(spark, X.label, "PM<sub>2.5</sub> &amp;  more") == "pm2 5 more"
    assert one(spark, X.rendered, "{station_name} - ({station_ref})", "London AB1", "ab1") == "London AB1"
    assert one(spark, X.rendered, "{station_name} ({station_ref})", "London", "X1") == "London (X1)"
    assert one(spark, X.station_label, "", "ref", "http://x.y/z - Site A") == "Site A" and one(spark, X.station_label, None, "ref", None) == "ref"
    assert one(spark, X.phenomenon_label, "", "http://a/b:pm10") == "pm10"
    assert one(spark, X.measure_code, "i-PM 2.5") == "pm25" and one(spark, X.measure_code, "unknown") is None


def test_source_times(spark):
    day = dt.datetime
    for date, time, want in (("31/12/2023", "24:00", day(2024, 1, 1)), ("01/02/24", "01:30", day(2024, 2, 1, 1, 30)), ("2024-02-29", "00:00", day(2024, 2, 29)), ("2023-02-29", "00:00", None)):
        assert one(spark, Z.utc_from_source, date, time) == want
    assert one(spark, Z.utc_without_zone, "2024-01-01T10:00:00") == one(spark, Z.utc_without_zone, "2024-01-01T12:00:00+02:00") == day(2024, 1, 1, 10)


def test_verification_and_float_bits(spark):
    assert one(spark, X.verification, " p ") == "P" and one(spark, X.verification, "") is None
    with pytest.raises(Exception, match="unknown verification status"):
        one(spark, X.verification, "Q")
    v = spark.createDataFrame([(1.0,), (-0.0,), (None,)], "v double")
    assert [r[0] for r in v.select(X.bits_float(X.float_bits(F.col("v")))).collect()] == [1.0, 0.0, None]
    assert [r[0] for r in v.select(X.float_bits(F.col("v"))).collect()] == ["3ff0000000000000", "0000000000000000", None]


def test_points_on_edges_and_in_holes(spark):
    ring = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    areas = geo.boxes(spark.createDataFrame([(7, [[ring(0.0, 10.0), ring(4.0, 6.0)], [ring(20.0, 22.0)]])], "code int, polygons array<array<array<array<double>>>>"))
    points = [(1, 1.0, 1.0), (2, 0.0, 5.0), (3, 5.0, 5.0), (4, 4.0, 5.0), (5, 21.0, 21.0), (6, 15.0, 15.0), (7, 10.0, 10.0)]
    got = {r["id"]: r["code"] for r in geo.located(spark.createDataFrame(points, "id int, lon double, lat double"), areas).collect()}
    assert got == {1: 7, 2: 7, 3: None, 4: None, 5: 7, 6: None, 7: 7}


def test_wide_and_triplet_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_text("sensor_id;timestamp;P1;P2\n5;2024-01-01T00:00:00;1.5;\n5;bad;2;x\n")
    got = {(r["measure"], r["value"], r["skipped"]) for r in files.read_wide_csv(spark, str(tmp_path / "w.csv"), {"P1": "pm10", "P2": "pm25"}, ["sensor_id"], "timestamp").collect()}
    assert got == {("pm10", 1.5, None), ("pm25", None, "empty"), ("pm10", 2.0, "bad_time"), ("pm25", None, "not_a_number")}
    lines = spark.createDataFrame([("01/01/2024,01:00,1.0,V,ugm3,2.0,P,ugm3",), ("01/01/2024,02:00,,,,3.0,R,ugm3",)], "value string")
    assert [(r["time"], r["measure"], r["value"], r["status"]) for r in files.read_triplets(lines, ["no2", "pm10"]).collect()] == [("01:00", "no2", "1.0", "V"), ("01:00", "pm10", "2.0", "P"), ("02:00", "pm10", "3.0", "R")]


def test_unlisted_files_and_column_sets(spark):
    disk = spark.createDataFrame([("a",), ("b",)], "file string")
    assert [r[0] for r in files.stale_files(disk, disk.limit(1)).collect()] == ["b"]
    with pytest.raises(ValueError, match="refusing"):
        files.stale_files(disk, disk.filter("false"))
    part = obs(spark, [0]).select("timeseries_id", "observed_at", "value")
    assert set(files.read_variants([part, part.withColumn("status", F.lit("P"))]).columns) == {"timeseries_id", "observed_at", "value", "status"}
    with pytest.raises(ValueError, match="unknown column set"):
        files.read_variants([part.withColumn("x", F.lit(1))])
