"""Fingerprints of groups of any size: no list of a group's rows, and the same hashes as over the whole list."""

import datetime
import hashlib

from pyspark.sql import functions as F

from chronoloom.plans import reconcile as R


def test_fingerprints_are_streamed(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [(k, i % 7, None if i == 3 else t + datetime.timedelta(seconds=i % 50), None if i % 5 == 0 else i / 8) for k, n in ((1, 400), (None, 90), (2, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "connector_id int, timeseries_id long, observed_at timestamp_ntz, value double").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        out = R.fingerprints(df, ["connector_id"], prefix="p/1\n")
        got = {r["connector_id"]: (r["n"], r["fingerprint"], r["first"], r["last"]) for r in out.collect()}
        plan = out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    hashes = [(r["connector_id"], r["observed_at"], r["h"]) for r in df.select("connector_id", "observed_at", F.sha2(R.row_text(), 256).alias("h")).collect()]
    for k in (1, None, 2):
        own = sorted(h for c, _, h in hashes if c == k)
        times = [x for c, x, _ in hashes if c == k and x]
        assert got.pop(k) == (len(own), hashlib.sha256(("p/1\n" + "\n".join(own)).encode()).hexdigest(), min(times), max(times))
    assert not got and "collect_list" not in plan
    assert R.fingerprints(df.filter("false"), ["connector_id"]).count() == 0


def test_row_text_tells_numbers_apart(spark):
    from chronoloom.plans.reconcile import row_text

    rows = spark.createDataFrame([(1.0,), (1.0 + 1e-10,), (1e20,), (float("nan"),), (None,), (0.0,), (-0.0,)], "value double")
    texts = [r[0] for r in rows.select(row_text(["value"])).collect()]
    assert len(set(texts)) == 6 and texts[5] == texts[6]
