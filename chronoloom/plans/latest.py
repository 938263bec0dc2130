"""Latest values: decoding, value policy, state transitions, snapshots. The same rules serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE = "connector_id int, timeseries_id int, observed_at string, value double"
KEYS = ["connector_id", "timeseries_id"]
#: measure -> largest value. Fixed values.
MAXIMA = {"pm25": 500.0, "pm10": 600.0}


def decoded(lines: DataFrame, column: str = "value", base64: bool = False) -> DataFrame:
    """Message fields, raw, and malformed; reason says why a message cannot be used: empty, not_base64 (where messages are
    wrapped so), not_json, no_connector, no_series (ids must be positive), no_time, bad_value (given, but no finite number)."""
    text = F.col(column)
    if base64:
        # Characters and length are looked at first, as decoding passes over what it does not know; line breaks may stand within.
        bare = F.regexp_replace(text, r"\s+", "")
        text = F.when(bare.rlike("^[A-Za-z0-9+/]+={0,2}$") & (F.length(bare) % 4 == 0), F.decode(F.unbase64(bare), "utf-8"))
    m = F.from_json(text, MESSAGE)
    given = F.get_json_object(text, "$.value")
    out = lines.withColumns({"__m": m, "__text": text, "__given": given}).select(*[c for c in lines.columns if c != column], F.col(column).alias("raw"), "__m.*", "__text", "__given")
    # A time without a zone is one of the session's, UTC.
    out = out.withColumn("observed_at", F.try_to_timestamp("observed_at").cast("timestamp_ntz"))
    value = F.col("value")
    reason = (
        F.when(F.col("raw").isNull() | (F.trim("raw") == ""), "empty").when(F.col("__text").isNull(), "not_base64").when(F.try_parse_json("__text").isNull() | ~F.ltrim("__text").startswith("{"), "not_json")
        .when(F.coalesce(F.col("connector_id"), F.lit(0)) <= 0, "no_connector").when(F.coalesce(F.col("timeseries_id"), F.lit(0)) <= 0, "no_series").when(F.col("observed_at").isNull(), "no_time")
        .when(F.col("__given").isNotNull() & (value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))), "bad_value")
    )
    return out.withColumns({"reason": reason, "malformed": reason.isNotNull()}).drop("__text", "__given")


def matrix_measure(code: Column) -> Column:
    compact = F.regexp_replace(F.lower(F.trim(code)), r"[\s_.-]", "")
    return F.when(compact.isin("pm25", "pm10", "no2"), compact)


def value_reason(measure: Column, value: Column) -> Column:
    m = matrix_measure(measure)
    out = F.when(m.isNull(), "unsupported_pollutant").when(value.isNull() | F.isnan(value), "missing_or_non_finite_value").when(value < 0, "negative_value")
    for name, top in MAXIMA.items():
        out = out.when((m == name) & (value > top), f"above_{name}_maximum")
    return out.otherwise("eligible")


def transitions(state: DataFrame, rows: DataFrame, batch: str) -> DataFrame:
    """What each row of a batch does to the state (applied_new, applied_newer, skipped_duplicate, skipped_older): rows are
    taken in seq order, and each is compared with the best before it. Within a batch equal times leave the first; against
    the state, a later batch wins at equal time. batch names the rows' batch number, which grows."""
    s = state.select(*KEYS, "observed_at", F.col("batch"), F.lit(-1).cast("long").alias("seq"), F.lit(True).alias("old"))
    both = s.unionByName(rows.select(*KEYS, "observed_at", F.col(batch).alias("batch"), F.col("seq").cast("long").alias("seq"), F.lit(False).alias("old")))
    w = Window.partitionBy(*KEYS).orderBy("batch", "seq").rowsBetween(Window.unboundedPreceding, -1)
    best = F.max(F.struct("observed_at", "batch")).over(w)
    now = F.struct("observed_at", "batch")
    what = F.when(best.isNull(), "applied_new").when(now > best, "applied_newer").when(now == best, "skipped_duplicate").otherwise("skipped_older")
    return both.withColumn("what", what).filter(~F.col("old")).drop("old")


def latest_state(rows: DataFrame, batch: str = "batch") -> DataFrame:
    """One row a key: the latest time; at equal times the latest batch; within a batch the first row."""
    rest = [c for c in rows.columns if c not in KEYS]
    return rows.groupBy(*KEYS).agg(F.max_by(F.struct(*rest), F.struct("observed_at", batch, -F.col("seq"))).alias("r")).select(*KEYS, "r.*")


def corrected(state: DataFrame, candidates: DataFrame) -> DataFrame:
    """Corrections: newer replaces, older is skipped, and at equal time other content replaces."""
    both = candidates.select(*KEYS, F.struct("observed_at", "value").alias("n")).join(state.select(*KEYS, F.struct("observed_at", "value").alias("s")), KEYS, "full_outer")
    n, s = F.col("n"), F.col("s")
    what = (
        F.when(n.isNull(), "unchanged").when(s.isNull(), "applied_new").when(n["observed_at"] > s["observed_at"], "applied_newer").when(n["observed_at"] < s["observed_at"], "skipped_older")
        .when(n["value"].eqNullSafe(s["value"]), "skipped_equal").otherwise("applied_same_timestamp_correction")
    )
    taken = F.when(what.startswith("applied"), n).otherwise(s)
    return both.select(*KEYS, taken["observed_at"].alias("observed_at"), taken["value"].alias("value"), what.alias("what"))


def fresh(rows: DataFrame, now: str, window: str | None) -> DataFrame:
    """Rows not older than the window (an interval text, none for all) before `now`, floored to the minute."""
    if window is None:
        return rows
    return rows.filter(F.col("observed_at") >= F.date_trunc("minute", F.lit(now).cast("timestamp_ntz")).cast("timestamp_ntz") - F.expr(f"INTERVAL {window}"))


def age_bucket(latest: Column, now: str) -> Column:
    t = F.lit(now).cast("timestamp_ntz")
    out = F.when(latest.isNull(), "never")
    for hours, name in ((3, "h3"), (6, "h6"), (24, "d1"), (168, "d7")):
        out = out.when(latest >= t - F.expr(f"INTERVAL {hours} HOURS"), name)
    return out.otherwise("older")


def freshness_matrix(rows: DataFrame, now: str) -> DataFrame:
    """Per source and measure: stations by age of their latest row."""
    last = rows.groupBy("connector_id", "pollutant_code", "station_id").agg(F.max("observed_at").alias("latest"))
    return last.withColumn("age", age_bucket(F.col("latest"), now)).groupBy("connector_id", "pollutant_code").pivot("age", ["h3", "h6", "d1", "d7", "older"]).agg(F.count(F.lit(1))).fillna(0)


def due(outbox: DataFrame, now: str, n: int) -> DataFrame:
    return outbox.filter(F.col("next_attempt_at") <= F.lit(now).cast("timestamp_ntz")).orderBy("next_attempt_at", "created_at", "id").limit(n)


#: attempts so far -> seconds to the next; later ones the last. Fixed values.
BACK_OFF, DEAD_AFTER = (30, 120, 600, 3600), 20


def resolved(outbox: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """The outbox after delivery results (id, ok, error, retry_in_seconds): delivered entries go, failed ones wait."""
    a = F.col("attempts")
    wait = F.when(a == 0, BACK_OFF[0]).when(a == 1, BACK_OFF[1]).when(a == 2, BACK_OFF[2]).otherwise(BACK_OFF[3])
    dead = a + 1 >= DEAD_AFTER
    given = F.greatest(F.lit(0), F.least(F.col("retry_in_seconds"), F.lit(3600)))
    seconds = F.when(dead, F.lit(3600)).when(F.col("retry_in_seconds").isNotNull(), given).otherwise(wait)
    error = F.coalesce("error", "last_error", F.lit("delivery failed"))
    out = outbox.join(results, "id", "left").filter(~F.coalesce("ok", F.lit(False)))
    failed = F.col("ok").isNotNull()
    return out.select(
        "id", F.when(failed, a + 1).otherwise(a).alias("attempts"),
        F.when(failed, F.when(dead, F.concat(F.lit("[dead_letter_threshold_reached] "), error)).otherwise(error)).otherwise(F.col("last_error")).alias("last_error"),
        F.when(failed, F.timestamp_add("SECOND", seconds, F.lit(now).cast("timestamp_ntz"))).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"),
    )
