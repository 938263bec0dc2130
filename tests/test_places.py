"""Areas found by tiles, classes of stored codes, sites, directories, manifests with issues, names and labels."""

import datetime

from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.operators import geo
from chronoloom.operators.windows import interval_faults
from chronoloom.plans import directory as D
from chronoloom.plans import snapshot as N
from chronoloom.plans import stores as S
from chronoloom.plans.latest import decoded


def square(x1, y1, x2, y2):
    return [[[[x1, y1], [x2, y1], [x2, y2], [x1, y2], [x1, y1]]]]


def test_how_places_are_found(spark):
    areas = spark.createDataFrame([("A", "first", square(0.0, 0.0, 4.0, 4.0), 0, 0), ("B", "second", square(4.0, 0.0, 11.0, 4.0), 1, 0), ("C", "third", square(4.0, 0.0, 11.0, 4.0), 2, 0)], "code string, name string, polygons array<array<array<array<double>>>>, tx int, ty int")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 4.5, 1.0), (3, 6.0, 1.0), (4, 50.0, 1.0), (5, 200.0, 1.0), (6, None, 1.0), (7, 4.0, 4.0), (8, 10.5, 1.0)], "id int, lon double, lat double")
    got = {r["id"]: (r["code"], r["how"]) for r in geo.found_places(points, areas).collect()}
    # 2 lies in tile 0, where only A is listed, and in B, which the next tile lists; an edge counts as inside.
    assert got == {1: ("A", "tile"), 2: ("B", "neighbour_tile"), 3: ("B", "tile"), 4: (None, "no_match"), 5: (None, "invalid_coordinate"), 6: (None, "invalid_coordinate"), 7: ("A", "tile"), 8: ("C", "tile")}


CASES = {
    "both match": (("A1", "Aa", "A1", "x", "tile"), ("L1", "Bb", "L1", "y", "tile"), []),
    "edge": (("A1", "Aa", "A1", "x", "neighbour_tile"), ("L1", "Bb", " L1 ", "y", "tile"), ["possible_boundary_edge"]),
    "failed": (("A1", "Aa", "A1", "x", "tile"), ("L1", "Bb", "L1", "y", "error"), ["lookup_error"]),
    "bad place": (("A1", "Aa", None, None, "invalid_coordinate"), ("L1", "Bb", None, None, "invalid_coordinate"), ["invalid_coordinates"]),
    "nothing there": (("A1", "Aa", None, None, "no_match"), ("L1", "Bb", None, None, "no_match"), ["first_no_match", "second_no_match"]),
    "another code": (("A1", "Aa", "A2", "x", "tile"), ("L1", "Bb", "L1", "y", "tile"), ["first_code_mismatch"]),
    "same name": (("A1", "St. Ives", "A2", "st ives", "tile"), ("L1", "Bb", "L2", "y", "tile"), ["first_code_mismatch", "second_code_mismatch", "possible_boundary_version_difference"]),
    "nothing stored": ((None, None, "A2", "x", "tile"), ("", "", "L2", "y", "neighbour_tile"), ["first_code_mismatch", "second_code_mismatch"]),
}


def test_classes_of_places(spark):
    rows = [(k, *a, *b) for k, (a, b, _) in CASES.items()]
    fields = ", ".join(f"{s}_{c} string" for s in ("first", "second") for c in ("stored", "stored_name", "code", "name", "how"))
    got = {r["k"]: (r["classes"], r["overall_match"]) for r in S.place_classes(spark.createDataFrame(rows, f"k string, {fields}"), "first", "second").collect()}
    assert got == {k: (c, k in ("both match", "edge", "failed")) for k, (*_, c) in CASES.items()}


DAY = datetime.date


def test_nested_intervals_overlap(spark):
    rows = [("nested", DAY(2024, 1, 1), DAY(2024, 12, 31)), ("nested", DAY(2024, 2, 1), DAY(2024, 2, 2)), ("nested", DAY(2024, 3, 1), DAY(2024, 3, 2)), ("chain", DAY(2024, 1, 1), DAY(2024, 1, 31)), ("chain", DAY(2024, 2, 1), None),
            ("open", DAY(2024, 1, 1), None), ("open", DAY(2024, 2, 1), None), ("inverted", DAY(2024, 5, 1), DAY(2024, 1, 1)), ("inverted", DAY(2024, 2, 1), DAY(2024, 2, 1))]
    got = {r["k"]: (r["overlaps"], r["open_ends"], r["valid"]) for r in interval_faults(spark.createDataFrame(rows, "k string, valid_from date, valid_to date"), "k").collect()}
    assert got == {"nested": (2, 0, False), "chain": (0, 1, True), "open": (1, 2, False), "inverted": (0, 0, True)}


def test_sites(spark):
    bridge = [("EA8", "UK1", "pm10", 1, 66, DAY(2020, 1, 1), DAY(2026, 5, 17)), ("EA8", "UK1", "pm10", 1, 66, DAY(2020, 1, 1), DAY(2026, 5, 17)), ("EA8", "UK1", "PM10", 1, 95, DAY(2026, 5, 18), None), ("EA8", "UK1", "o3", 1, 5, DAY(2020, 1, 1), None),
              ("EA9", "UK1", "no2", 2, 7, DAY(2020, 1, 1), None), ("EB1", "UK2", "no2", 3, 8, DAY(2020, 1, 1), DAY(2020, 12, 31)), ("EB1", "UK2", "no2", 3, 9, DAY(2020, 3, 1), DAY(2020, 4, 1)), ("EB1", "UK2", "no2", 3, 10, DAY(2020, 5, 1), DAY(2020, 4, 1)), ("EB1", "UK2", "pm10", 3, 11, None, None)]
    rows = spark.createDataFrame(bridge, "site_ref string, other_ref string, measure string, station_id int, timeseries_id int, valid_from date, valid_to date")
    sel = spark.createDataFrame([("a", "ea8", None), ("b", None, "uk1"), ("c", None, "UK2"), ("d", "zz", None)], "selector string, site_ref string, other_ref string")
    got = sorted(((r["selector"], r["site_ref"], r["measure"], r["timeseries_id"], r["problem"]) for r in S.resolved_sites(rows, sel, ["station_id", "timeseries_id"], ["no2", "pm10"]).collect()), key=str)
    want = [("a", "EA8", "pm10", 66, None), ("a", "EA8", "pm10", 95, None), ("b", None, None, None, "several_sites"), ("c", "EB1", "no2", 8, None), ("c", "EB1", "no2", 9, "overlap"), ("c", "EB1", "no2", 10, "inverted"), ("c", "EB1", "pm10", 11, "missing_start"), ("d", None, None, None, "no_rows")]
    assert got == sorted(want, key=str)


def codes(spark):
    rows = [("SW1A 1AA", "51.501009", "-0.141588", "", "E14001530", "E09000033", "Parish A", "London"), ("sw1a1ab", "51.5", "-0.14", None, "E14001530", "E09000033", "Parish A", "London"), ("EC1A 1BB", "51.52", "-0.1", "", "E14001531", "E09000019", "Parish B", "London"),
            ("SW1A 1ZZ", "51.5", "-0.1", "202001", "E1", "E2", "Parish A", "London"), ("nonsense", "51.5", "-0.1", "", None, None, None, None), ("SW1A 1AC", "x", "-0.1", "", None, None, None, None), ("EC1A 1BB", "51.525", "-0.1", "", "E14001531", "E09000019", "Parish B", "London")]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "place int, postcode string, lat string, lon string, terminated string, pcon string, la string, area string, town string")


def test_directory(spark, tmp_path):
    told = D.write_directory(codes(spark), str(tmp_path)).first().asDict()
    assert told == {"rows": 7, "terminated_skipped": 1, "invalid_code_skipped": 1, "invalid_coordinate_skipped": 1, "codes": 3, "shards": 2, "pairs": 2, "without_pair": 0}
    exact = {r["code"]: r for r in spark.read.json(str(tmp_path / "shards")).collect()}
    assert (exact["SW1A1AA"]["lat"], exact["SW1A1AA"]["lon"], exact["SW1A1AA"]["pcon"], exact["SW1A1AA"]["la"], exact["SW1A1AA"]["shard"]) == (51.501009, -0.141588, "E14001530", "E09000033", "SW")
    assert exact["SW1A1AB"]["area_town_id"] == exact["SW1A1AA"]["area_town_id"] != exact["EC1A1BB"]["area_town_id"]
    assert exact["EC1A1BB"]["lat"] == 51.525 and "SW1A1ZZ" not in exact  # the last row of a code
    suggested = {r["code"]: r for r in spark.read.json(str(tmp_path / "suggest")).collect()}
    assert suggested["SW1A1AA"]["shown"] == "SW1A 1AA" and "lat" not in suggested["SW1A1AA"].asDict()
    names = {r["area_town_id"]: (r["area"], r["town"]) for r in spark.read.json(str(tmp_path / "dictionary")).collect()}
    assert names[exact["SW1A1AA"]["area_town_id"]] == ("Parish A", "London")
    hints = {(r["prefix"], r["code"]) for r in spark.read.json(str(tmp_path / "hints")).collect()}
    assert hints == {("S", "SW1A1AA"), ("S", "SW1A1AB"), ("SW", "SW1A1AA"), ("SW", "SW1A1AB"), ("E", "EC1A1BB"), ("EC", "EC1A1BB")}


def test_samples_of_prefixes(spark):
    rows = spark.range(2000).selectExpr("concat(char(65 + id % 2), cast(id * 37 % 1000 as string)) as code")
    got = {(r["prefix"], r["code"]) for r in D.prefix_samples(rows, 4, (1, 2, 3)).collect()}
    all_codes = sorted({r["code"] for r in rows.collect()})
    assert got == {(p, c) for n in (1, 2, 3) for p in {c[:n] for c in all_codes if len(c) >= n} for c in [x for x in all_codes if x.startswith(p)][:4]}


def test_manifests_with_issues(spark, tmp_path):
    texts = {"own": {1: '{"row_count": 3, "c": {"7": 2, "8": 1}}', 2: '{"row_count": 3', 4: '{"row_count": 3}', 5: '{"row_count": 0}', 6: '[1]', 7: '{"row_count": 3, "c": {"x": 1, "9": -2}}'}, "index": {1: '{"row_count": 3, "c": {"7": 3}}', 2: '{"c": {"7": 1}}', 3: '{"c": {"7": 1}}', 4: "{}", 5: "{}", 6: '{"c": {"7": 1}}'}}
    units = spark.createDataFrame([(i,) for i in range(1, 8)], "unit int")
    read = {}
    for side, docs in texts.items():
        for i, text in docs.items():
            (tmp_path / side / f"unit={i}").mkdir(parents=True)
            (tmp_path / side / f"unit={i}" / "manifest.json").write_text(text)
        found = S.listed_documents(spark, str(tmp_path / side), "manifest.json", ["unit"])
        read[side] = S.documents_of(units, found.withColumn("unit", F.col("unit").cast("int")), ["unit"])
    got = {r["unit"]: (r["own_issue"], r["index_issue"], r["own_series"], r["own_rows"], r["kind"]) for r in S.manifest_issues(units, read["own"], read["index"], ["unit"], "c", ["row_count"]).collect()}
    assert got == {
        1: ("ok", "ok", 2, 3, "none"), 2: ("invalid_json", "ok", 0, 0, "connector_manifest"), 3: ("missing_file", "ok", 0, 0, "connector_manifest"), 4: ("counts_missing", "counts_missing", 0, 3, "both"),
        5: ("ok", "ok", 0, 0, "none"), 6: ("invalid_json", "ok", 0, 0, "connector_manifest"), 7: ("counts_empty_object", "missing_file", 0, 3, "both"),
    }


def test_names_labels_and_units(spark):
    one = lambda column, *v: spark.createDataFrame([v], ", ".join(f"c{i} string" for i in range(len(v)))).select(column(*[F.col(f"c{i}") for i in range(len(v))])).first()[0]
    name = lambda *v: one(X.display_name, *v)
    assert name("{station_name} ({station_ref})", "Leeds", "L", "R1", "5") == "Leeds (R1)"
    assert name("{station_name} ({station_ref})", "Leeds r1", "L", "R1", "5") == "Leeds r1"
    assert name("{station_label} - {station_ref}", "Leeds", "L", None, "5") == "L"
    assert name("{STATION_NAME}", "Leeds", "L", "R1", "5") == "{STATION_NAME}"
    assert name("{station_label}", "Leeds", None, "R1", "5") == "Leeds - R1"  # nothing comes of it
    assert name(None, "Leeds R1", None, "r1", "5") == "Leeds R1" and name(" ", None, "Label", "R1", "5") == "Label"
    assert name(None, None, " ", "R1", "5") == "R1" and name(None, None, None, None, "5") == "Station 5" and name(None, None, None, None, None) is None
    assert one(X.label, "PM<sub>2.5</sub>&nbsp;&amp; caf&eacute;&#8211;x") == "pm2 5 caf x"
    assert one(X.unit_code, " µgm-3") == "ug/m3" and one(X.unit_code, "mgm-3") == "mg/m3" and one(X.unit_code, None) == "" and one(X.unit_code, "K") == "K"


def test_wrapped_messages(spark):
    import base64

    good = '{"connector_id": 1, "timeseries_id": 2, "observed_at": "2024-01-01T00:00:00Z", "value": 1.5}'
    wrap = lambda t: base64.b64encode(t.encode()).decode()
    rows = [wrap(good), wrap(good.replace("1.5", "null")), wrap(good)[:-2], "", None, wrap("no json"), wrap(good.replace('"connector_id": 1', '"connector_id": 0')), wrap(good.replace("2024-01-01T00:00:00Z", "soon")), wrap(good.replace("1.5", '"NaN"')), wrap("[1]")]
    got = [r["reason"] for r in decoded(spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, value string").coalesce(1), base64=True).orderBy("i").collect()]
    assert got == [None, None, "not_base64", "empty", "empty", "not_json", "no_connector", "no_time", "bad_value", "not_json"]


def test_snapshot_rows_and_why_others_are_not_shown(spark):
    table = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    at = datetime.datetime(2024, 1, 1)
    state = table("connector_id int, timeseries_id long, observed_at timestamp_ntz, value double", (9, 1, at, 5.0), (9, 2, at, -1.0), (9, 3, at, None), (9, 4, at, 5.0), (9, 5, at, 5.0), (9, 6, at, 5.0), (9, 7, at, 501.0), (9, 8, at, 5.0), (9, 99, at, 5.0))
    series = table("timeseries_id long, station_id int, phenomenon_id int, series_connector_id int, series_label string", (1, 1, 1, 2, ""), (2, 1, 1, 2, ""), (3, 1, 1, 2, ""), (4, 2, 1, 2, ""), (5, 3, 1, 2, ""), (6, 1, 3, 2, ""), (7, 1, 1, 2, ""), (8, 1, 2, None, ""))
    stations = table("station_id int, station_name string, station_label string, station_ref string, pcon_code string, la_code string, network_id int", (1, "Leeds", "L", "R1", None, "E1", 1), (2, "York", "Y", "R2", " ", None, 1), (3, "Hull", "H", "R3", "E2", None, 2))
    networks = table("network_id int, network_code string, network_name string, template string", (1, "n", "Net", "{station_name} ({station_ref})"), (2, None, "Other", None))
    connectors = table("connector_id int, connector_name string", (2, "two"), (9, "nine"))
    phenomena = table("phenomenon_id int, property_id int, notation string, measure_label string, label string, unit string", (1, 1, "", None, "http://x/pm", "ug.m-3"), (2, None, "NO2", None, None, " ppb "), (3, 2, None, None, None, None))
    properties = table("property_id int, property_code string", (1, "PM2.5"), (2, "O3"))
    told = N.told_rows(state, series, stations, networks, connectors, phenomena, properties)
    assert {r["timeseries_id"]: r["why"] for r in told.collect()} == {1: None, 2: "negative_value", 3: "missing_or_non_finite_value", 4: "no_area", 5: "missing_network", 6: "unsupported_pollutant", 7: "above_pm25_maximum", 8: None, 99: "missing_series"}
    shown = {r["timeseries_id"]: (r["connector_name"], r["pollutant_code"], r["unit"], r["phenomenon"], r["display_name"], r["la_code"]) for r in N.public_rows(told).collect()}
    assert shown == {1: ("two", "pm25", "µg/m³", "pm", "Leeds (R1)", "E1"), 8: ("nine", "no2", "ppb", "NO2", "Leeds (R1)", "E1")}
    assert {r["why"]: r["n"] for r in N.refused_counts(told).collect()}[None] == 2


def test_snapshot_keeps_pairs_apart_whose_numbers_collide(spark, tmp_path):
    """Parts beyond a million, where s * 1,000,000 + p names two pairs; the copied suppliers keep their names."""
    import duckdb

    from chronoloom import catalog

    con, source = duckdb.connect(), "/root/testdata/sf0.001"
    shifted = {"supplier": "s_suppkey + 1000 * i AS s_suppkey", "part": "p_partkey + 1000000 * i AS p_partkey", "lineitem": "l_orderkey + 10000000 * i AS l_orderkey, l_partkey + 1000000 * i AS l_partkey", "nation": "n_nationkey AS n_nationkey", "region": "r_regionkey AS r_regionkey"}
    for name, keys in shifted.items():
        copies = 1 if name in ("nation", "region") else 2
        con.execute(f"COPY (SELECT * EXCLUDE (i) REPLACE ({keys}) FROM '{source}/{name}.parquet', range({copies}) r(i)) TO '{tmp_path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    for name in ("d29_refused_rows", "d29_public_rows"):
        got = catalog.QUERIES[name](spark, str(tmp_path))
        want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str), name
