"""Tree fingerprints: one definition, many tasks, descent to the rows that differ; canonical rows and their hash."""

import datetime
import hashlib
import itertools
import math
import struct

import pytest
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.plans import reconcile as R
from chronoloom.plans import trees as T

AT = datetime.datetime(2024, 1, 1)
SCHEMA = "connector_id int, timeseries_id int, observed_at timestamp_ntz, value double"


def rows_of(spark, rows):
    return spark.createDataFrame([(c, s, AT + datetime.timedelta(seconds=i), v) for c, s, i, v in rows], SCHEMA)


def brute(hashes, depth):
    """{prefix: (n, hash)} of one group from its row hashes, in plain Python."""
    counts = {h: hashes.count(h) for h in set(hashes)}
    sha = lambda items: hashlib.sha256("\n".join(sorted(items)).encode()).hexdigest()
    nodes = {}
    for p in {h[:depth] for h in counts}:
        own = [h for h in counts if h[:depth] == p]
        nodes[p] = (sum(counts[h] for h in own), sha([f"{h}:{counts[h]}" for h in own]))
    level = dict(nodes)
    for size in range(depth - 1, -1, -1):
        up = {}
        for p in {q[:size] for q in level}:
            own = [q for q in level if q[:size] == p]
            up[p] = (sum(level[q][0] for q in own), sha([f"{q[size]}:{level[q][1]}" for q in own]))
        nodes |= up
        level = up
    return nodes


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_nodes(spark, depth):
    rows = rows_of(spark, [(c, i % 5, i % 40, i / 8 if i % 9 else None) for c in (1, 2) for i in range(150)]).repartition(3)
    got = {}
    for r in T.tree(rows, ["connector_id"], depth).collect():
        assert len(r["prefix"]) == r["level"]
        got.setdefault(r["connector_id"], {})[r["prefix"]] = (r["n"], r["hash"])
    hashes = rows.select("connector_id", F.sha2(R.row_text(), 256).alias("h")).collect()
    for c in (1, 2):
        assert got.pop(c) == brute([r["h"] for r in hashes if r["connector_id"] == c], depth)
    assert not got
    root = {r["connector_id"]: r["fingerprint"] for r in T.roots(rows, ["connector_id"], depth, "p\n").collect()}
    assert root[1] == hashlib.sha256(("p\n" + brute([r["h"] for r in hashes if r["connector_id"] == 1], depth)[""][1]).encode()).hexdigest()
    assert T.tree(rows.filter("false"), ["connector_id"], depth).count() == 0


def test_a_large_group_is_hashed_by_several_tasks(spark):
    rows = spark.range(20_000).selectExpr("1 as connector_id", "cast(id % 7 as int) as timeseries_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as observed_at", "id / 3 as value")
    depth = T.depth_for(rows, keys=["connector_id"])
    assert depth == 2 and T.depth_for(rows.limit(10), keys=["connector_id"]) == 0 and T.depth_for(rows.filter("false"), keys=["connector_id"]) == 0
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        leaves = T.leaves(rows, ["connector_id"], depth)
        parts = leaves.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.sum("n").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["n"] for r in parts) < 12_000
    assert leaves.agg(F.max("n")).first()[0] < 4 * T.LEAF


def test_one_changed_row_is_located(spark):
    a = spark.range(3000).selectExpr("cast(id % 2 as int) as connector_id", "cast(id % 7 as int) as timeseries_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as observed_at", "id / 3 as value")
    b = a.withColumn("value", F.when((F.col("connector_id") == 1) & (F.col("value") == 7.0), 8.0).otherwise(F.col("value"))).unionByName(a.filter("value = 100.0"))
    keys = ["connector_id"]
    found = T.differing_leaves(T.tree(a, keys, 2), T.tree(b, keys, 2), keys, 2)
    assert found.count() <= 3
    got = {(r["connector_id"], r["value"], r["n_a"], r["n_b"], r["result"]) for r in T.differing_rows(a, b, found, keys, 2).collect()}
    assert got == {(1, 7.0, 1, 0, "missing_in_b"), (1, 8.0, 0, 1, "extra_in_b"), (0, 100.0, 1, 2, "count_differs")}
    assert T.differing_leaves(T.tree(a, keys, 2), T.tree(a, keys, 2), keys, 2).count() == 0
    gone = T.differing_leaves(T.tree(a, keys, 2), T.tree(b.filter("connector_id = 0"), keys, 2), keys, 2)
    assert T.differing_rows(a, b.filter("connector_id = 0"), gone, keys, 2).filter("connector_id = 1").count() == 1500


def test_identities(spark):
    make = lambda rows: spark.createDataFrame(rows, "k int, n long, fingerprint string")
    got = T.identity_states(make([(1, 5, "a"), (2, 5, "b"), (3, 6, "c"), (4, 1, "d")]), make([(1, 5, "a"), (2, 5, "x"), (3, 5, "y"), (5, 1, "e")]), ["k"])
    assert {r["k"]: r["state"] for r in got.collect()} == {1: "same", 2: "changed_with_equal_count", 3: "changed", 4: "new", 5: "gone"}


def floats():
    tiny, top = 5e-324, 1.7976931348623157e308
    base = [0.0, -0.0, 1.0, -1.25, 0.1, 1 / 3, tiny, -tiny, 2.2250738585072014e-308, 2.225073858507201e-308, top, -top, 1e22, 123456.789]
    return base + [math.nextafter(2.0**e, way) for e in range(-1073, 1024, 13) for way in (0.0, math.inf)] + [2.0**e for e in range(-1074, 1024, 7)]


def test_bits_of_doubles(spark):
    df = spark.createDataFrame([(v,) for v in floats()], "v double").select("v", X.float_bits(F.col("v")).alias("t")).select("v", "t", X.bits_float(F.col("t")).alias("back"))
    for r in df.collect():
        assert r["t"] == struct.pack(">d", r["v"] + 0.0).hex(), r["v"]
        assert r["back"] == r["v"]
    odd = spark.createDataFrame([("7ff0000000000000",), ("fff0000000000000",), ("7ff8000000000000",), (None,)], "t string").select(X.bits_float(F.col("t"))).collect()
    assert [odd[0][0], odd[1][0], odd[3][0]] == [math.inf, -math.inf, None] and math.isnan(odd[2][0])
    assert spark.createDataFrame([(None,)], "v double").select(X.float_bits(F.col("v"))).first()[0] is None
    for v in (math.nan, math.inf):
        with pytest.raises(Exception, match="finite"):
            spark.createDataFrame([(v,)], "v double").select(X.float_bits(F.col("v"))).collect()


GOLD = [
    ((1, 10, 101, "no2", "2026-07-24 01:00:00", -1.25, "P"), '[1,10,101,"no2","2026-07-24T01:00:00.000Z","bff4000000000000","P"]'),
    ((1, 10, 101, "no2", "2026-07-24 02:00:00", -0.0, None), '[1,10,101,"no2","2026-07-24T02:00:00.000Z","0000000000000000",null]'),
    ((2, None, 102, "pm25", "2026-07-24 02:00:00.125", 0.1, "R"), '[2,null,102,"pm25","2026-07-24T02:00:00.125Z","3fb999999999999a","R"]'),
]
FIELDS = ["connector", "station", "series", "measure", "at", "value", "status"]


def canonical(spark, rows):
    df = spark.createDataFrame(rows, "connector int, station int, series int, measure string, t string, value double, status string").withColumn("at", F.col("t").cast("timestamp_ntz"))
    return df.withColumn("encoded", X.canonical_row(*[F.col(c) for c in FIELDS])).withColumn("observed_at", F.col("at"))


def test_canonical_rows(spark):
    assert [r["encoded"] for r in canonical(spark, [x for x, _ in GOLD]).collect()] == [y for _, y in GOLD]


@pytest.mark.parametrize(("field", "value", "says"), [(0, 0, "connector"), (0, None, "connector"), (1, -1, "station"), (2, None, "series"), (3, "NO2", "lower-case"), (3, None, "lower-case"), (4, "2026-07-24 01:00:00.000001", "milliseconds"), (4, None, "milliseconds"), (5, math.nan, "finite"), (5, math.inf, "finite"), (5, None, "finite"), (6, "provisional", "P, R or null")])
def test_what_has_no_canonical_form_is_an_error(spark, field, value, says):
    row = list(GOLD[0][0])
    row[field] = value
    with pytest.raises(Exception, match=says):
        canonical(spark, [tuple(row)]).select("encoded").collect()


def test_content_hash(spark):
    def hashed(rows):
        return R.content_hashes(canonical(spark, rows).withColumn("k", F.lit(1)), ["k"], "encoded", "status", "v1\n").first()

    rows = [x for x, _ in GOLD[:2]]
    first = hashed(rows)
    assert first["fingerprint"] == hashlib.sha256(("v1\n" + "".join(sorted(y + "\n" for _, y in GOLD[:2]))).encode()).hexdigest()
    assert (first["n"], first["p"], first["r"], first["without"]) == (2, 1, 0, 1)
    assert hashed(rows[::-1])["fingerprint"] == first["fingerprint"]
    changes = [(0, 2), (1, 11), (2, 102), (3, "o3"), (4, "2026-07-24 03:00:00"), (5, -1.5), (6, "R")]
    seen = {first["fingerprint"], hashed([*rows, rows[0]])["fingerprint"]}
    for i, v in changes:
        seen.add(hashed([tuple(v if k == i else x for k, x in enumerate(rows[0])), rows[1]])["fingerprint"])
    assert len(seen) == 2 + len(changes)


def test_verification_statuses(spark):
    rows = [" P ", "provisional", "R", " ratified ", " ", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "s string").select(X.verification(F.col("s"))).collect()]
    assert got == ["P", "P", "R", "R", None, None]
    with pytest.raises(Exception, match="verified"):
        spark.createDataFrame([("verified",)], "s string").select(X.verification(F.col("s"))).collect()


def test_repeated_rows_count(spark):
    one = [(1, 1, i, float(i)) for i in range(20)]
    roots = {T.roots(rows_of(spark, one + one[:k]), ["connector_id"], 1).first()["fingerprint"] for k in range(3)}
    assert len(roots) == 3
    orders = {T.roots(rows_of(spark, list(p) + one[4:]), ["connector_id"], 1).first()["fingerprint"] for p in itertools.islice(itertools.permutations(one[:4]), 3)}
    assert len(orders) == 1
