"""Quality rules: a threshold table compiled into one projection of Spark expressions.

Words are runs of characters other than space and the five ASCII controls from tab to carriage return. Every
measure is a count, and every rule compares a percentage of two counts with whole numbers, so that verdicts are
exact in any engine.

Defined results: a null text has no words and fails the base rules, as an empty one does; repeated rows are judged
each on its own; an empty table gives an empty result; extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they you "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
    "de la le et les des en un du une que est pour qui dans par sur au il pas avec se son "
    "el que y los del se las por con no una su para es al lo como"
).split()

#: (rule, part, whole, least percentage, largest percentage). A rule holds if the whole is 0.
RULES = (
    ("word_length", "word_chars", "n_words", 200, 1500),
    ("symbols", "n_symbols", "n_words", 0, 30),
    ("stop_words", "n_stop_words", "n_words", 3, 100),
    ("duplicate_lines", "n_dup_lines", "n_lines", 0, 40),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8

P = "__quality_"


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """docs with the measures in columns that begin with P. Each step is named where several expressions of the next
    one read it, so that Spark computes it once a row."""
    c = lambda name: F.col(P + name)
    out = docs.withColumn(P + "text", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns(
        {
            P + "words": F.filter(F.split(c("text"), SPACES), lambda w: w != ""),
            P + "lines": F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(WORD_CHAR)),
        }
    )
    out = out.withColumns(
        {
            P + "n_words": F.size(c("words")).cast("long"),
            P + "n_lines": F.size(c("lines")).cast("long"),
            P + "word_chars": F.length(F.array_join(c("words"), "")).cast("long"),
            P + "n_symbols": (F.length(c("text")) - F.length(F.regexp_replace(c("text"), SYMBOLS, ""))).cast("long"),
            P + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            P + "n_stop_words": F.size(F.filter(c("words"), lambda w: w.isin(*STOP_WORDS))).cast("long"),
            P + "hashes": F.transform(c("words"), lambda w: F.xxhash64(w)),
        }
    )
    starts = F.greatest(F.size(c("hashes")) - (WINDOW - 1), F.lit(0))
    window = lambda _, i: F.xxhash64(*[F.get(c("hashes"), i + k) for k in range(WINDOW)])
    out = out.withColumn(P + "windows", F.transform(F.slice(c("hashes"), F.lit(1), starts), window))
    # Few texts repeat a window; only those are sorted.
    repeats = F.size(F.array_distinct(c("windows"))) < F.size(c("windows"))
    keyed = F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn(P + "sorted", F.when(repeats, F.sort_array(keyed)))
    h = lambda i: F.get(c("sorted"), i)["h"]
    again = F.filter(c("sorted"), lambda x, i: (x["h"] == F.when(i > 0, h(i - 1))) | (x["h"] == h(i + 1)))
    out = out.withColumn(P + "again", F.when(c("sorted").isNotNull(), F.sort_array(F.transform(again, lambda x: x["i"]))))
    covered = F.aggregate(
        F.transform(c("again"), lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(c("again"), i + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, b: a + b,
    )
    out = out.withColumn(P + "n_repeat_words", F.coalesce(F.when(c("sorted").isNotNull(), covered), F.lit(0)).cast("long"))
    # A generated column is not replaced by its expression: a later filter would otherwise be pushed below all steps, and each of them computed again for each place that reads it.
    counts = F.explode(F.array(F.struct(*[c(x).alias(x) for x in MEASURES])))
    return out.select(*[F.col(f"`{x}`") for x in docs.columns], counts.alias(P + "counts"))


def _verdict(rules) -> tuple[Column, Column]:
    n = lambda name: F.col(P + "counts")[name]
    failed = (n("n_words") < LEAST_WORDS) | (100 * n("n_repeat_words") > MOST_REPEATED * n("n_words"))
    kept = ~failed
    for _, part, whole, least, most in rules:
        kept = kept & (100 * n(part) >= least * n(whole)) & (100 * n(part) <= most * n(whole))
    return failed, kept


def quality_rules(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, all counts, base_failed, and kept. kept is false if base_failed, or if a rule of the table fails.

    n_dup_lines counts lines with a word that equal an earlier line; n_repeat_words counts words inside windows of
    eight words that occur twice or more in the text, the first included. Windows are compared by a 64-bit hash of
    their words' 64-bit hashes.
    """
    failed, kept = _verdict(rules)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(P + "in"))
    return _measured(slim, P + "in").select("doc_id", P + "counts.*", failed.alias("base_failed"), kept.alias("kept"))


def passing(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that the rules keep."""
    _, kept = _verdict(rules)
    return _measured(docs, text_col).filter(kept).select(*[F.col(f"`{x}`") for x in docs.columns])


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_CHECKS = " AND ".join(f"100 * {part} >= {least} * {whole} AND 100 * {part} <= {most} * {whole}" for _, part, whole, least, most in RULES)

ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 6, 1))) AS i FROM w)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id
), v AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM m
)
SELECT *, (NOT base_failed) AND {_CHECKS} AS kept FROM v
"""
