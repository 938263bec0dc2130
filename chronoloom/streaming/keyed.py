"""Latest values as Spark's keyed state: a row a key in a RocksDB state store, read and written for the keys of a
micro-batch alone. What a batch did to its keys is written as rows of their own; the current values are the newest row of
each key in those changes, folded into a base now and then.

Rules are those of the batch form (`plans.latest`): a later time replaces, an earlier one does not; at equal times a later
batch wins, and within a batch the row of smallest seq, the order that lines have in a column or a field of that name;
without one, the larger value. With `retain`, a timer of event time takes a key out of the state
once the watermark is that far beyond its value; rows that far behind are dropped, so that batch and stream agree on data
that span less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from chronoloom.plans.latest import KEYS, decoded, value_reason
from chronoloom.sources.commits import Log
from chronoloom.sources.shared import files_of

MOST_KEYS = 500_000
#: What a row of a batch did to the state, counted for each key.
WHAT = ["applied_new", "applied_newer", "skipped_duplicate", "skipped_older"]
CHANGE = "connector_id int, timeseries_id int, at long, value double, seq long, changed boolean, expired boolean, " + ", ".join(f"{w} long" for w in WHAT)
VALUES = "connector_id int, timeseries_id int, observed_at timestamp_ntz, value double"
ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch's checkpoint then holds its changes, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
LEAST, LOWEST = np.iinfo(np.int64).min, float("-inf")


class Newest(StatefulProcessor):
    """Keeps (at: microseconds, value) of each key. retain: milliseconds of event time, 0 for ever."""

    def __init__(self, retain: int = 0):
        self.retain = retain

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "at long, value double")

    def _keep(self, was, at: int, value) -> None:
        self.latest.update((at, value))
        if self.retain:
            if was is not None:
                self.handle.deleteTimer(was // 1000 + self.retain)
            self.handle.registerTimer(at // 1000 + self.retain)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(None, initialState.at, initialState.value)

    def handleInputRows(self, key, rows, timerValues):
        state = self.latest.get()
        was = None if state is None else state[0]
        # Of a key's rows a batch needs times and order alone, 16 bytes each; the value of the best row so far goes along.
        times, order, best = [], [], None
        for r in rows:
            times.append(np.frombuffer(r.times, np.int64))
            order.append(np.frombuffer(r.orders, np.int64))
            rank = (r.at, -r.seq, LOWEST if r.value is None else r.value)
            if best is None or rank > best[0]:
                best = (rank, r.at, r.seq, r.value)
        at = np.concatenate(times)[np.argsort(np.concatenate(order), kind="stable")]
        before = np.maximum.accumulate(np.concatenate([[LEAST if was is None else was], at]))[:-1]
        same = at == before
        # The first row at the state's own time comes from a later batch than that, and replaces it.
        again = bool(same.any()) and was is not None and bool((same & (before == was)).any())
        newer = int(np.sum(at > before)) + again - (was is None)
        _, top, seq, value = best
        changed = was is None or top >= was
        if changed:
            self._keep(was, top, value)
        counts = [int(was is None), newer, int(np.sum(same)) - again, int(np.sum(at < before))]
        yield Row(connector_id=key[0], timeseries_id=key[1], at=top if changed else was, value=value if changed else state[1], seq=seq if changed else None, changed=changed, expired=False, **dict(zip(WHAT, counts, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state = self.latest.get()
        if state is not None and state[0] // 1000 + self.retain <= expiredTimerInfo.getExpiryTimeInMs():
            self.latest.clear()
            yield Row(connector_id=key[0], timeseries_id=key[1], at=state[0], value=None, seq=None, changed=True, expired=True, **dict.fromkeys(WHAT, 0))

    def close(self) -> None:
        pass


def good_rows(lines: DataFrame, bindings: DataFrame | None = None) -> DataFrame:
    """(keys, at, value, seq) of the lines that can be used: well-formed ones, of series that bindings know with a value
    that their measure allows."""
    rows = decoded(lines)
    seq = F.col("seq") if "seq" in rows.columns else F.get_json_object("raw", "$.seq").try_cast("long")
    rows = rows.withColumn("seq", F.coalesce(seq.cast("long"), F.lit(0))).filter("not malformed")
    if bindings is not None:
        rows = rows.join(bindings.select("timeseries_id", "pollutant_code"), "timeseries_id").filter(value_reason(F.col("pollutant_code"), F.col("value")) == "eligible")
    return rows.select(*KEYS, F.unix_micros(F.col("observed_at").cast("timestamp")).alias("at"), "value", "seq")


def packed(rows: DataFrame, together: bool = True) -> DataFrame:
    """good_rows to a row for each key in an Arrow batch, so that a key with many rows costs Python little for each: the
    times and orders of all its rows as arrays of longs, and at, value and seq of the best. Not together: each row by itself."""

    def made(batches):
        for batch in batches:
            keys = [np.asarray(batch.column(k)).astype(np.int64) for k in KEYS]
            at, seq = (np.asarray(batch.column(c)) for c in ("at", "seq"))
            value = batch.column("value").fill_null(LOWEST).to_numpy(zero_copy_only=False)
            by = np.lexsort((value, -seq, at, keys[1], keys[0])) if together else np.arange(len(at))
            new = np.ones(len(by), bool)
            if together:
                new[1:] = np.any([np.diff(k[by]) != 0 for k in keys], axis=0)
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(by))
            # Rows of a key keep the order they came in, which tells equal seq apart.
            own = by if not together else np.lexsort((np.arange(len(at)), keys[1], keys[0]))
            part = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(start, end, strict=True)], pa.binary())
            best = batch.take(pa.array(by[end - 1]))
            yield pa.RecordBatch.from_arrays([*[best.column(c) for c in (*KEYS, "at", "value", "seq")], part(at[own]), part(seq[own])], names=[*KEYS, "at", "value", "seq", "times", "orders"])

    return rows.select(*KEYS, "at", "value", "seq").mapInArrow(made, "connector_id int, timeseries_id int, at long, value double, seq long, times binary, orders binary")


def changes(rows: DataFrame, retain: str | None = None, seed: DataFrame | None = None) -> DataFrame:
    """A stream of good_rows to a row for each key and batch: its value after the batch, whether that changed, and what
    its rows did. retain is an interval text; seed has (keys, observed_at, value) to start from."""
    start = None
    if seed is not None:
        start = seed.select(*KEYS, F.unix_micros(F.col("observed_at").cast("timestamp")).alias("at"), "value").groupBy(*KEYS)
    if not retain:
        return packed(rows).groupBy(*KEYS).transformWithState(Newest(), CHANGE, "Update", "None", start)
    spark = rows.sparkSession
    span = spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {retain}"))).first()[0]
    # Rows that are too late are dropped one by one, so each stays by itself.
    timed = packed(rows, together=False).withColumn("event_time", F.timestamp_micros("at")).withWatermark("event_time", retain)
    return timed.groupBy(*KEYS).transformWithState(Newest(span), CHANGE, "Update", "EventTime", start)


class LatestValues:
    """Latest values under `root`: checkpoint (with the state store), changes/batch=N, counts/batch=N, dead/batch=N for
    lines that are no messages (with the reason), base/v=N for folded changes, named by a log."""

    def __init__(self, spark: SparkSession, root: str, bindings: str | None = None, most_keys: int = MOST_KEYS, retain: str | None = None, seed: DataFrame | None = None):
        self.spark, self.root, self.bindings, self.most_keys, self.retain, self.seed = spark, root, bindings, most_keys, retain, seed
        self.log = Log(spark, f"{root}/base")

    def _counts(self, before: int) -> int:
        """Keys in the state before a batch."""
        if before < 0:
            return self.seed.count() if self.seed is not None else 0
        return self.spark.read.schema("keys long").parquet(f"{self.root}/counts/batch={before}").first()["keys"]

    def write(self, batch_rows: DataFrame, batch: int) -> None:
        """Rows of one batch, once: a repeated batch replaces its own folders. More keys than allowed end the batch before
        it is committed."""
        path = f"{self.root}/changes/batch={batch}"
        batch_rows.write.mode("overwrite").parquet(path)
        done = self.spark.read.schema(CHANGE).parquet(path).agg(F.count_if("changed").alias("changed"), F.count_if("expired").alias("expired"), *[F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in WHAT])
        told = done.withColumn("keys", F.lit(self._counts(batch - 1)) + F.col("applied_new") - F.col("expired"))
        told.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts/batch={batch}")
        if (n := self._counts(batch)) > self.most_keys:
            raise RuntimeError(f"the state has {n} keys; {self.most_keys} are allowed")

    def run(self, lines: DataFrame) -> int:
        """Reads the stream of lines to its end and returns the newest batch; dimensions are read anew by each run. Lines
        that are no messages are put aside by a query of its own, before the others count as read."""
        for k, v in ROCKS.items():
            self.spark.conf.set(k, v)
        aside = lambda df, batch: df.write.mode("overwrite").parquet(f"{self.root}/dead/batch={batch}")
        bad = decoded(lines).filter("malformed").select("raw", "reason")
        bad.writeStream.foreachBatch(aside).option("checkpointLocation", f"{self.root}/checkpoint-dead").trigger(availableNow=True).start().awaitTermination()
        known = self.spark.read.parquet(self.bindings) if self.bindings else None
        stream = changes(good_rows(lines, known), self.retain, self.seed)
        query = stream.writeStream.foreachBatch(self.write).outputMode("update").option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        self.progress = query.recentProgress
        return self.newest()

    def _all(self, kind: str, schema: str, after: int = -1) -> DataFrame:
        """The rows of all batches after one, with batch."""
        files, at = files_of(self.spark, f"{self.root}/{kind}")
        if not files.exists(at):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.root}/{kind}").filter(F.col("batch") > after)

    def counts(self) -> DataFrame:
        """(batch, keys, changed, expired and what rows did) of each batch."""
        return self._all("counts", "changed long, expired long, " + ", ".join(f"{w} long" for w in WHAT) + ", keys long")

    def newest(self) -> int:
        """The newest batch that was written, -1 if there is none."""
        found = self.counts().agg(F.max("batch")).first()[0]
        return -1 if found is None else int(found)

    def read(self, batch: int | None = None) -> DataFrame:
        """Values as they stand after a batch (the newest): the base that is not newer, and changes since."""
        _, entry = self.log.newest()
        base = entry.get("batch", -1)
        if batch is not None and base > batch:
            raise ValueError(f"batch {batch} is folded into the base of batch {base}")
        rows = self._all("changes", CHANGE, base).filter("changed")
        rows = rows if batch is None else rows.filter(F.col("batch") <= batch)
        rows = rows.select(*KEYS, "at", "value", "expired", "batch")
        if base >= 0:
            old = self.spark.read.schema("connector_id int, timeseries_id int, at long, value double").parquet(f"{self.root}/base/v={base}")
        elif self.seed is not None:
            old = self.seed.select(*KEYS, F.unix_micros(F.col("observed_at").cast("timestamp")).alias("at"), "value")
        else:
            old = None
        if old is not None:
            rows = rows.unionByName(old.withColumns({"expired": F.lit(False), "batch": F.lit(-1).cast("long")}))
        last = rows.groupBy(*KEYS).agg(F.max_by(F.struct("at", "value", "expired"), "batch").alias("r")).select(*KEYS, "r.*").filter("not expired")
        return last.select(*KEYS, F.timestamp_micros("at").cast("timestamp_ntz").alias("observed_at"), "value")

    def fold(self) -> int:
        """Folds the changes so far into a new base, written aside and then named; readers see one or the other."""
        upto = self.newest()
        if upto > self.log.newest()[1].get("batch", -1):
            rows = self.read(upto).select(*KEYS, F.unix_micros(F.col("observed_at").cast("timestamp")).alias("at"), "value")
            rows.write.mode("overwrite").parquet(f"{self.root}/base/v={upto}")
            self.log.add({"batch": upto})
        return upto
