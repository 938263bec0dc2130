"""File skipping, two-step commits, migration, dense numbers, range tiles."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from chronoloom.operators.ranks import dense_ids
from chronoloom.plans import migration as M
from chronoloom.plans import trees as T
from chronoloom.plans.stores import in_ranges
from chronoloom.sources import commits, skipping
from chronoloom.sources.files import PARTITIONS, read_history, write_history, write_index
from chronoloom.streaming import latest as L

SCHEMA = "timeseries_id int, observed_at timestamp_ntz, value double, day_utc date, connector_id int, pollutant_code string"


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("history"))
    rows = spark.range(4000).selectExpr("cast(id % 40 as int) as timeseries_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 3) as observed_at", "cast(id as double) as value", "cast(1 + id % 2 as int) as connector_id", "if(id % 40 < 20, 'no2', 'pm25') as pollutant_code")
    write_history(rows, root)
    back = read_history(spark, root, SCHEMA)
    skipping.write_index(skipping.file_index(back), f"{root}-index")
    return root, rows, skipping.read_index(spark, f"{root}-index")


def opened(df):
    """How many files the scan read, from its own metric."""
    df.collect()
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        p = plans.pop()
        metrics = p.metrics()
        if metrics.contains("numFiles"):
            found.append(metrics.apply("numFiles").value())
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plans.append(p.executedPlan())
        elif "QueryStage" in p.getClass().getSimpleName():
            plans.append(p.plan())
        else:
            children = p.children()
            plans += [children.apply(i) for i in range(children.size())]
    return sum(found)


@pytest.mark.parametrize(("series", "start", "end"), [([7], "2024-01-03", "2024-01-04"), ([7, 8, 31], "2024-01-02 05:00", "2024-01-05 07:30"), ([99], "2024-01-01", "2024-02-01"), ([7], "2025-01-01", "2025-02-01"), (list(range(40)), "2024-01-01", "2024-02-01")])
def test_only_files_that_may_hold_rows_are_opened(spark, history, series, start, end):
    root, rows, index = history
    wanted = skipping.asked(spark, series, start, end)
    files = skipping.files_to_read(index, wanted)
    named = {r["file"] for r in files.collect()}
    lo, hi = (datetime.datetime.fromisoformat(x) for x in (start, end))
    assert named == {r["file"] for r in index.collect() if r["timeseries_id"] in series and r["last"] >= lo and r["first"] < hi}
    scan = skipping.read_files(spark, root, files, SCHEMA)
    path = lambda uri: uri.removeprefix("file:").replace("///", "/")
    assert set(map(path, scan.inputFiles())) == set(map(path, named))
    if named:
        assert opened(scan) == len(named)
    got = skipping.wanted_rows(spark, root, files, wanted, SCHEMA).select("timeseries_id", "observed_at", "value")
    whole = rows.filter(F.col("timeseries_id").isin(series) & (F.col("observed_at") >= F.lit(start).cast("timestamp_ntz")) & (F.col("observed_at") < F.lit(end).cast("timestamp_ntz"))).select("timeseries_id", "observed_at", "value")
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_manifests_name_a_superset(spark, history):
    root, _, index = history
    skipping.write_manifests(index, f"{root}-manifests")
    wanted = skipping.asked(spark, [7, 31], "2024-01-03", "2024-01-04 12:00")
    by_index = {r["file"] for r in skipping.files_to_read(index, wanted).collect()}
    by_manifest = {r["file"] for r in skipping.files_by_manifest(spark, f"{root}-manifests", wanted).collect()}
    assert by_index <= by_manifest and len(by_manifest) < index.select("file").distinct().count()


def test_index_of_new_files_alone(spark, history):
    root, rows, index = history
    old = index.filter("day_utc <> date'2024-01-02'").unionByName(index.limit(1).withColumn("file", F.lit("gone.parquet")))
    again = skipping.refreshed(old, read_history(spark, root, SCHEMA))
    same = index.select(again.columns)
    assert again.exceptAll(same).isEmpty() and same.exceptAll(again).isEmpty()


def table_rows(spark, days, extra=()):
    rows = [(f"d{d}", i, float(d * i)) for d in days for i in range(5)] + list(extra)
    return spark.createDataFrame(rows, "day string, ident int, value double")


def publish(table, rows, **more):
    hashes = T.roots(rows, ["day"], 0, columns=["ident", "value"]).withColumnRenamed("fingerprint", "hash")
    return table.publish(rows, hashes, **more)


def content(table):
    return sorted(map(tuple, table.read().select("day", "ident", "value").collect()))


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_versions(spark, tmp_path, form):
    table = commits.Versioned(spark, str(tmp_path), ["day"], form)
    assert table.read() is None
    one = table_rows(spark, [1, 2, 3])
    assert publish(table, one) == {"write": 3}
    assert content(table) == sorted(map(tuple, one.collect()))
    assert publish(table, one) == {"skip": 3} and table.log.newest()[0] == 0
    two = table_rows(spark, [2, 3, 4], [("d3", 9, 1.0)])
    assert publish(table, two) == {"skip": 1, "replace": 1, "write": 1, "delete": 1}
    assert content(table) == sorted(map(tuple, two.collect()))
    versions = {r["v"] for r in table.manifest().collect()}
    assert len(versions) == 2  # the unchanged partition stays where it was written


def test_a_run_that_ends_between_the_steps_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = commits.Versioned(spark, str(tmp_path), ["day"])
    one = table_rows(spark, [1, 2])
    publish(table, one)
    monkeypatch.setattr(table, "switch", lambda entry: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        publish(table, table_rows(spark, [2, 7]))
    again = commits.Versioned(spark, str(tmp_path), ["day"])
    assert content(again) == sorted(map(tuple, one.collect()))
    # A log entry that was cut off is passed over as well; the next publication goes on from there.
    (tmp_path / "log" / f"{1:020d}.json").write_text('{"version": "x')
    assert content(again) == sorted(map(tuple, one.collect()))
    publish(again, table_rows(spark, [2, 7]))
    assert content(again) == sorted(map(tuple, table_rows(spark, [2, 7]).collect())) and again.log.newest()[0] == 2


def test_two_writers_at_once(spark, tmp_path):
    log = commits.Log(spark, str(tmp_path))
    log.add({"a": 1})
    (tmp_path / "log" / f"{1:020d}.json").write_text("{}")
    other = commits.Log(spark, str(tmp_path))
    other._entries = lambda: [(0, f"{0:020d}.json")]
    with pytest.raises(Exception, match="already exists"):
        other.add({"b": 2})


def test_snapshots(spark, tmp_path):
    rows = spark.createDataFrame([("pm25", 1, "2024-01-01 01:00", 2.5), ("pm25", 3, "2024-01-01 01:00", None), ("no2", 2, "2024-01-01 00:30:00.000001", 1.0)], "pollutant_code string, timeseries_id int, t string, value double").withColumn("observed_at", F.col("t").cast("timestamp_ntz")).drop("t")
    table = commits.Versioned(spark, str(tmp_path), L.SNAPSHOT, "json")
    assert L.publish_snapshots(rows, table) == {"write": 2}
    number, entry = table.log.newest()
    told = entry["snapshots"]["pm25"]
    assert (told["n"], told["next_since"], told["next_since_id"]) == (2, "2024-01-01 01:00:00", "3")
    assert L.publish_snapshots(rows, table) == {"skip": 2} and table.log.newest()[0] == number
    assert L.publish_snapshots(rows.withColumn("value", F.col("value") + F.when(F.col("timeseries_id") == 1, 1.0).otherwise(0.0)), table) == {"skip": 1, "replace": 1}
    back = {(r["pollutant_code"], r["timeseries_id"], str(r["observed_at"]), r["value"]) for r in table.read().collect()}
    assert back == {("pm25", 1, "2024-01-01 01:00:00", 3.5), ("pm25", 3, "2024-01-01 01:00:00", None), ("no2", 2, "2024-01-01 00:30:00.000001", 1.0)}
    lines = [json.loads(x) for p in tmp_path.glob("data/v=*/pollutant_code=no2/*.json") for x in p.read_text().splitlines()]
    assert [x["timeseries_id"] for x in lines] == [2]


def observations(spark, n=60):
    return spark.range(n).selectExpr("cast(1 + id % 2 as int) as connector_id", "cast(10 + id % 4 as int) as timeseries_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) as observed_at", "cast(id as double) as value")


def links(spark):
    return spark.createDataFrame([(10, 1, 100, "no2"), (11, 2, 101, "pm25"), (12, 1, 102, "no2"), (13, 2, 103, "pm25")], "timeseries_id int, connector_id int, station_id int, pollutant_code string")


def test_migration(spark, tmp_path):
    target = commits.Versioned(spark, str(tmp_path), PARTITIONS)
    rows = observations(spark)
    done = M.migrate(rows, links(spark), target, most=4)
    assert done["problems"] == {} and set(done["actions"]) == {"write"}
    got = target.read().collect()
    assert len(got) == 60
    parts = {}
    for r in got:
        parts.setdefault((r["day_utc"], r["connector_id"], r["pollutant_code"]), []).append((r["timeseries_id"], r["observed_at"], r["part"]))
    for own in parts.values():
        assert [p for *_, p in sorted(own)] == [i // 4 for i in range(len(own))]
    assert set(M.migrate(rows, links(spark), target, most=4)["actions"]) == {"skip"}
    assert set(M.migrate(rows.filter("day(observed_at) <> 2"), links(spark), target, most=4)["actions"]) == {"skip", "delete"}
    assert target.read().filter("day(day_utc) = 2").isEmpty()


def test_migration_stops_before_the_switch(spark, tmp_path, monkeypatch):
    target = commits.Versioned(spark, str(tmp_path), PARTITIONS)
    rows = observations(spark)
    with pytest.raises(ValueError, match="no_binding"):
        M.migrate(rows, links(spark).filter("timeseries_id <> 12"), target)
    with pytest.raises(ValueError, match="other_connector"):
        M.migrate(rows, links(spark).withColumn("connector_id", F.lit(1)), target)
    assert target.read() is None
    M.migrate(rows.filter("day(observed_at) = 1"), links(spark), target)
    before = target.read().count()
    real = M.numbered_parts
    monkeypatch.setattr(M, "numbered_parts", lambda *a: real(*a).filter(F.rand() > -1).withColumn("value", F.col("value")))
    inner = target.publish

    def lossy(kept, hashes, extra, before_switch):  # a writer that loses rows
        return inner(kept, hashes, extra, before_switch=lambda written, meant: before_switch(written.filter("timeseries_id <> 11"), meant))

    monkeypatch.setattr(target, "publish", lossy)
    with pytest.raises(M.CountsDiffer):
        M.migrate(rows, links(spark), target)
    assert target.read().count() == before
    told = M.bound(rows, links(spark).filter("timeseries_id <> 12")).groupBy("problem").count().collect()
    assert {r["problem"]: r["count"] for r in told} == {None: 45, "no_binding": 15}


def test_dense_numbers(spark):
    rows = spark.range(3000).selectExpr("if(id % 11 = 0, null, cast(id * 7919 % 500 as string)) as a", "cast(id % 3 as int) as b").repartition(5)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else small ranges are one
    try:
        out = dense_ids(rows, ["a", "b"])
        got = {(r["a"], r["b"]): r["id"] for r in out.collect()}
        plan = out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    want = sorted({(r["a"], r["b"]) for r in rows.collect()}, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert got == {x: i + 1 for i, x in enumerate(want)}
    assert "SinglePartition" not in plan
    assert dense_ids(rows.filter("false"), ["a", "b"]).count() == 0


def test_ranges_of_any_width(spark):
    ranges = spark.createDataFrame([(1, 5, 9), (2, -1000, 10**12), (3, 7, 7), (4, 2**62, 2**62 + 5), (5, 9, 5), (6, 0, 4095), (7, 1, 4096)], "r int, a long, b long")
    wanted = [-1000, -1001, 5, 7, 9, 10, 4095, 4096, 10**12, 10**12 + 1, 2**62 + 5]
    got = in_ranges(spark.createDataFrame([(x,) for x in wanted], "ident long"), ranges, "ident", "a", "b")
    assert sorted((r["ident"], r["r"]) for r in got.collect()) == sorted((x, r) for x in wanted for r, a, b in map(tuple, ranges.collect()) if a <= x <= b)
    assert in_ranges(got.select("ident"), ranges.filter("false"), "ident", "a", "b").count() == 0


def test_index_profiles(spark, tmp_path):
    from chronoloom.plans.index_levels import from_observations

    rows = spark.range(30).selectExpr("1 as connector_id", "2 as station_id", "3 as timeseries_id", "'no2' as pollutant_code", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) as observed_at", "cast(id as double) as value", "id as seq")
    index = from_observations(rows)
    write_index(index, str(tmp_path / "data"), "data")
    write_index(index, str(tmp_path / "debug"), "debug", "2024-02-01 00:00:00")
    data, debug = (spark.read.parquet(str(tmp_path / p)).drop("day_utc") for p in ("data", "debug"))
    assert len(data.columns) == 11 and {"daqi_missing_reason", "eaqi_missing_reason", "timestamp_hour_utc"} <= set(data.columns)
    assert len(debug.columns) == 22 and str(debug.first()["computed_at_utc"]) == "2024-02-01 00:00:00"
