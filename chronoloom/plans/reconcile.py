"""Reconciliation of two copies of observations: fingerprints, differences, plans."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions.time import hour_start
from chronoloom.operators.sets import multiset_difference


def row_text(columns=("timeseries_id", "observed_at", "value")) -> Column:
    """A row as text: times in microseconds, numbers with all digits that tell them apart, -0 as 0, null as nothing."""
    forms = {"observed_at": F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "value": (F.col("value") + F.lit(0.0)).cast("string")}
    return F.concat_ws("|", *[F.coalesce(forms.get(c, F.col(c).cast("string")), F.lit("")) for c in columns])


def digest(items: Column, prefix: str = "") -> Column:
    return F.sha2(F.concat(F.lit(prefix), F.array_join(items, "\n")), 256)


def _streamed(keys: list[str], prefix: str, after: str = ""):
    """Batches of (keys, observed_at, h) in order of keys and h to (keys, n, fingerprint, first, last). Line feeds stand
    between the h of a group; after follows the last."""

    def run(batches):
        group, types = None, None

        def row(g):
            g["sha"].update(after.encode())
            return [pa.array([v], t) for v, t in zip((*g["key"], g["n"], g["sha"].hexdigest(), g["first"], g["last"]), types, strict=True)]

        names = [*keys, "n", "fingerprint", "first", "last"]
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.field("observed_at").type
            types = [*(batch.schema.field(k).type for k in keys), pa.int64(), pa.string(), at, at]
            change = np.zeros(batch.num_rows, bool)
            for k in keys:
                c = batch.column(k)
                one, two = c.slice(1), c.slice(0, len(c) - 1)
                other = pc.or_(pc.fill_null(pc.not_equal(one, two), False), pc.xor(one.is_null(), two.is_null()))
                change[1:] |= other.to_numpy(zero_copy_only=False)
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            done = []
            for start, end in zip(starts, starts[1:], strict=False):
                part = batch.slice(start, end - start)
                key = tuple(part.column(k)[0].as_py() for k in keys)
                if group is None or group["key"] != key:
                    if group is not None:
                        done.append(row(group))
                    group = {"key": key, "n": 0, "sha": hashlib.sha256(prefix.encode()), "first": None, "last": None}
                group["sha"].update((("\n" if group["n"] else "") + "\n".join(part.column("h").to_pylist())).encode())
                group["n"] += part.num_rows
                times = pc.min_max(part.column("observed_at")).as_py()
                group["first"] = min((x for x in (group["first"], times["min"]) if x is not None), default=None)
                group["last"] = max((x for x in (group["last"], times["max"]) if x is not None), default=None)
            if done:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*done, strict=True)], names=names)
        if group is not None:
            yield pa.RecordBatch.from_arrays(row(group), names=names)

    return run


def fingerprints(rows: DataFrame, keys: list[str], columns=("timeseries_id", "observed_at", "value"), prefix: str = "") -> DataFrame:
    """(keys, n, fingerprint, first, last): the hash of a group's row hashes in order. The row hashes are sorted by Spark,
    on disk where need be, and stream through SHA-256, so that no group is held as a list or a string; as the hash
    is one sequence, a group is still read by one task. Coarser levels hash their children's fingerprints."""
    hashed = rows.select(*keys, "observed_at", F.sha2(row_text(columns), 256).alias("h"))
    fields = {f.name: f.dataType.simpleString() for f in hashed.schema}
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keys), "n long, fingerprint string", *(f"{c} {fields['observed_at']}" for c in ("first", "last"))])
    return hashed.repartition(*keys).sortWithinPartitions(*keys, "h").mapInArrow(_streamed(keys, prefix), schema)


def content_hashes(rows: DataFrame, keys: list[str], encoded: str, status: str, prefix: str) -> DataFrame:
    """(keys, n, p, r, without, fingerprint): the hash of the prefix and of a group's encoded rows in order, a line each, and
    rows by verification status. As one sequence by definition it is streamed by one task a group (see fingerprints)."""
    told = rows.groupBy(*keys).agg(F.count_if(F.col(status) == "P").alias("p"), F.count_if(F.col(status) == "R").alias("r"), F.count_if(F.col(status).isNull()).alias("without"))
    lines = rows.select(*keys, "observed_at", F.col(encoded).alias("h"))
    fields = {f.name: f.dataType.simpleString() for f in lines.schema}
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keys), "n long, fingerprint string", *(f"{c} {fields['observed_at']}" for c in ("first", "last"))])
    hashed = lines.repartition(*keys).sortWithinPartitions(*keys, "h").mapInArrow(_streamed(keys, prefix, "\n"), schema)
    return hashed.select(*keys, "n", "fingerprint").join(told, keys)


def hour_buckets(obs: DataFrame) -> DataFrame:
    return fingerprints(obs.withColumn("hour", hour_start("observed_at")), ["connector_id", "hour"])


def rolled_up(parts: DataFrame, keys: list[str], order: list[str], prefix: str = "") -> DataFrame:
    """Coarser fingerprints from ordered finer ones."""
    listed = F.array_sort(F.collect_list(F.struct(*order, "fingerprint")))
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), digest(F.transform(listed, lambda x: x["fingerprint"]), prefix).alias("fingerprint"))


def compared(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Buckets of both sides: deletable, or why not; extra ones of b."""
    out = a.select(*keys, F.col("n").alias("n_a"), F.col("fingerprint").alias("f_a")).join(b.select(*keys, F.col("n").alias("n_b"), F.col("fingerprint").alias("f_b")), keys, "full_outer")
    result = F.when(F.col("n_a").isNull(), "extra_in_b").when(F.col("n_b").isNull(), "missing_in_b").when(F.col("n_a") != F.col("n_b"), "count_mismatch").when(F.col("f_a") != F.col("f_b"), "fingerprint_mismatch").otherwise("deletable")
    return out.select(*keys, "n_a", "n_b", result.alias("result"))


def repairs(comparison: DataFrame) -> DataFrame:
    """Mismatches that can be repaired from a, and those where b has more."""
    more = (F.col("result") == "count_mismatch") & (F.col("n_b") > F.col("n_a"))
    return comparison.filter(~F.col("result").isin("deletable", "extra_in_b")).withColumn("repair", F.when(more, "other_store_has_more").otherwise("repairable"))


def deletion_plan(comparison: DataFrame, gate: DataFrame) -> DataFrame:
    """A source's day is deleted whole or not at all: all its hours are deletable and its gate is complete."""
    day = comparison.filter("n_a is not null").groupBy("connector_id", F.to_date("hour").alias("day")).agg(F.count("*").alias("buckets"), F.count_if(F.col("result") == "deletable").alias("eligible"))
    out = day.join(gate, ["connector_id", "day"], "left")
    reason = F.when(~F.coalesce("complete", F.lit(False)), "history_not_complete_for_connector_day").when(F.col("eligible") != F.col("buckets"), "connector_day_not_fully_eligible")
    return out.select("connector_id", "day", "buckets", "eligible", reason.isNull().alias("planned"), reason.alias("reason"))


def restore_plan(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a that b lacks (missing) or holds with another value (conflict), by series and time."""
    keys = ["timeseries_id", "observed_at"]
    out = a.groupBy(*keys).agg(F.min("value").alias("value_a"), F.count_distinct("value").alias("na")).join(b.groupBy(*keys).agg(F.min("value").alias("value_b"), F.count_distinct("value").alias("nb")), keys, "left")
    action = F.when(F.col("na") > 1, "conflicting_repeats").when(F.col("nb").isNull(), "missing").when((F.col("nb") > 1) | (F.col("value_a") != F.col("value_b")), "conflict")
    return out.select(*keys, "value_a", "value_b", action.alias("action")).filter("action is not null")


def tolerance_difference(a: DataFrame, b: DataFrame, keys: list[str], fields: list[str], tolerance: float) -> DataFrame:
    """(keys, field, left, right, kind): missing and extra rows, and fields that differ by more than the tolerance."""
    both = a.select(*keys, F.struct(*fields).alias("l")).join(b.select(*keys, F.struct(*fields).alias("r")), keys, "full_outer")
    close = lambda f: F.col(f"l.{f}").eqNullSafe(F.col(f"r.{f}")) | F.coalesce(F.abs(F.col(f"l.{f}") - F.col(f"r.{f}")) <= tolerance, F.lit(False))
    checks = F.array(*[F.when(~close(f), F.struct(F.lit(f).alias("field"), F.col(f"l.{f}").cast("double").alias("left"), F.col(f"r.{f}").cast("double").alias("right"), F.lit("mismatch").alias("kind"))) for f in fields])
    whole = lambda kind: F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("double").alias("left"), F.lit(None).cast("double").alias("right"), F.lit(kind).alias("kind")))
    found = F.when(F.col("r").isNull(), whole("missing")).when(F.col("l").isNull(), whole("extra")).otherwise(F.array_compact(checks))
    return both.select(*keys, F.explode(found).alias("x")).select(*keys, "x.*")


def multiset_report(a: DataFrame, b: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Per value of `by`: rows of both sides, matched, missing, unexpected."""
    n = multiset_difference(a, b, keys)
    return n.groupBy(by).agg(*[F.sum(c).alias(c) for c in ("n_left", "n_right", "matched", "missing", "unexpected")])


def store_counts(counts: DataFrame, stores: list[str]) -> DataFrame:
    """Tagged counts (store, day, connector_id, n) side by side; a store without a row stays null. Adds status."""
    out = counts.groupBy("day", "connector_id").pivot("store", stores).agg(F.sum("n"))
    first = F.col(stores[0])
    flags = [F.when(F.col(s).isNull(), F.lit(f"{s}_missing")).when(F.col(s) != first, F.lit(f"{s}_differs")) for s in stores]
    status = F.concat_ws("|", *flags)
    return out.withColumns({**{f"diff_{s}": F.col(s) - first for s in stores[1:]}, "status": F.when(status == "", "ok").otherwise(status)})


def sampled(rows: DataFrame, text: str, percent: int) -> DataFrame:
    """A fixed share of rows: a base-31 hash of the text's characters modulo 2**32, modulo 100, below percent."""
    walk = F.aggregate(F.filter(F.split(F.col(text), ""), lambda c: c != ""), F.lit(0).cast("long"), lambda h, c: (h * 31 + F.ascii(c)) % 4294967296)
    return rows.filter(walk % 100 < percent)
