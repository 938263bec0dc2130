"""A supervised quality classifier on subword embeddings.

A document's features are its words and the three-byte stretches inside and around them, hashed to BUCKETS rows of an
embedding table, and one feature for each word that repeats the one before it. The rows are averaged, a linear layer and
a softmax give the class; both are learned by stochastic gradient descent in numpy, one document at a time with a
falling step. Since everything after the average is linear, scoring needs one number for each bucket: how far its row
moves the margin between the classes.

The fit uses at most SAMPLE labelled rows of each class, those of the smallest hashed ids; only their hashed counts go
to the driver, at most BUCKETS numbers for each. Scoring covers all rows in one pass.

Defined results: null and empty texts have the one feature that every document has, and so a score; repeated rows score
alike; if a class has no labelled row, every score is 0.5; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import BYTE_BACK, BYTE_STEP, SPACE, Sums, bounds, per_worker, slim_batches, utf8, words

BITS, WIDTH, SAMPLE, EPOCHS, STEP = 18, 16, 1000, 8, 0.5
BUCKETS = 1 << BITS
ALWAYS, REPEATS = 0, 1
SPREAD = 0x9E3779B97F4A7C15  # an odd multiplier


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a batch, by row."""
    hashes, row, *_ = words(column, sums=per_worker("byte sums", lambda: Sums(BYTE_STEP, BYTE_BACK)))
    data, offsets = utf8(column)
    n = len(column)
    space = SPACE[data]
    d = np.where(space, np.uint8(32), data).astype(np.uint64)
    lie = np.searchsorted(offsets, np.arange(len(data)), side="right") - 1
    gram_row = lie[2:][lie[2:] == lie[:-2]] if len(data) > 2 else lie[:0]
    gram = (d[:-2] << np.uint64(16) | d[1:-1] << np.uint64(8) | d[2:])[lie[2:] == lie[:-2]] if len(data) > 2 else d[:0]
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) + 1
    bucket = np.concatenate([np.full(n, ALWAYS), ((hashes * np.uint64(SPREAD)) >> np.uint64(64 - BITS)).astype(np.int64) | 2, ((gram * np.uint64(SPREAD)) >> np.uint64(64 - BITS)).astype(np.int64) | 2, np.full(len(again), REPEATS)])
    rows = np.concatenate([np.arange(n), row, gram_row, row[again]])
    return bucket, rows


def fit(documents: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> np.ndarray:
    """documents: (buckets, counts, label 0 or 1). The margin of class 1 for each bucket, as float32."""
    labels = {y for *_, y in documents}
    if labels != {0, 1}:
        return np.zeros(BUCKETS, np.float32)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    out = np.zeros((2, WIDTH), np.float32)
    steps, done = EPOCHS * len(documents), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(documents)):
            bucket, count, label = documents[i]
            share = (count / count.sum()).astype(np.float32)
            mean = share @ table[bucket]
            z = out @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            rate = STEP * (1 - done / steps)
            back = out.T @ p
            out -= rate * np.outer(p, mean)
            # Rows are moved as if each had the full weight, as is usual for averaged embeddings with hashed features.
            table[bucket] -= rate * np.minimum(share * 50, 1)[:, None] * back
            done += 1
    return table @ (out[1] - out[0])


def held_out(id_col: str, parts: int, part: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % parts == part


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """docs (doc_id, text), labels (doc_id, label 0 or 1)."""

    def counted(parts):
        for batch in parts:
            bucket, row = features(batch.column(0))
            order = np.argsort(row, kind="stable")
            bucket, at = bucket[order], bounds(row[order], batch.num_rows)
            found = [np.unique(bucket[at[i] : at[i + 1]], return_counts=True) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int32).tobytes() for x, _ in found]), pa.array([x.astype(np.int32).tobytes() for _, x in found]), batch.column(1)], names=["bucket", "n", "label"])

    chosen = [labels.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most twice `sample` ids
    rows = docs.join(chosen, "doc_id").select("text", F.col("label").cast("int").alias("label")).mapInArrow(counted, "bucket binary, n binary, label int").collect()
    documents = [(np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["n"], np.int32), r["label"]) for r in rows]
    return fit(sorted(documents, key=lambda x: (x[2], x[0].tobytes(), x[1].tobytes())))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 4, part: int = 2, least: float = 0.7, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id modulo parts is part; such rows teach nothing), score (probability of
    label 1) and predicted (1 if score >= least). Only texts are inputs of a score."""
    slim_batches(docs.sparkSession)
    slim = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    known = labels.select("doc_id", F.col(label).alias("label")).filter(~held_out("doc_id", parts, part) & F.col("label").isin(0, 1))
    margin = train(slim, known, sample).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(margin)  # BUCKETS numbers

    def scored(batches):
        margin = sent.value
        for batch in batches:
            bucket, row = features(batch.column(1))
            n = batch.num_rows
            z = np.bincount(row, margin[bucket], n) / np.bincount(row, minlength=n)
            score = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= least).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return slim.mapInArrow(scored, "doc_id long, score double, predicted int").select("doc_id", held_out("doc_id", parts, part).alias("held_out"), "score", "predicted")
