"""The corpus pipeline: stages over documents, each written by the caller and read again by the next.

Quality rules drop documents; line dedup takes repeated lines out of texts and drops documents left without a word;
near-dedup keeps one document of each group; decontamination drops documents that hold a benchmark item; packing gives
the pieces of sequences. All stages but the last return the columns of documents, in their types.

Defined results: an empty table gives an empty result; extra columns, of whatever names, are kept. Null and empty texts
fail the quality rules; given to a later stage they stay, and packing gives them the end token alone. Rows that share an
id are judged by their own texts; equal rows of one id stay or go together, and so keep what one of them keeps. A row
without an id comes last in line dedup, and near-dedup keeps it. Of equal documents the smallest id stays. Very long
texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm import decontamination, line_dedup, near_dedup, packing, quality_rules
from chronoloom.llm.tables import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the text. A document that loses its last word goes: all it had is kept elsewhere."""
    out = line_dedup.deduplicated(docs)
    left = F.col("text").rlike(quality_rules.WORD_CHAR) | (F.col(line_dedup.P + "counts.removed") == 0)
    return out.filter(left).select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(docs, k=5, percent=80)
    gone = found.filter("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near_duplicates), ("decontamination", decontaminated), ("packing", packed)]

#: Connected groups, learned hashes and tokenizers are not to be had in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), *[docs][: i > 0])
    return STAGES[-1][1](spark, docs, sf_dir)
