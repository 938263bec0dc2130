"""Removal of passages that occur earlier in the corpus, by word windows found through anchors.

A window is `length` consecutive words. Each window has an anchor: of the ANCHOR-word stretches inside it, the one of
the smallest hash, the leftmost of equals. Equal windows have equal anchors at equal places, so a window can only
repeat if its anchor's hash does. About one word in seven starts an anchor; anchors alone travel in the first step.

1. Anchors (hash, doc_id, place) of all texts; the hashes that occur twice or more, by a grouping with map-side counts
   and a join that Spark may split where a hash is frequent.
2. Windows on those anchors (hash, doc_id, place): the first place of each hash, by a grouping with map-side minimum.
3. A window on a repeated anchor that is not the first of its hash is a repeat; its words go.

The windows of step 2 are compared by 64-bit hashes of their words' 64-bit hashes. The result covers whole texts and
all documents; no step gathers a group of rows in one task.

Suffix automata of the whole corpus would have to go to every executor, and each shard's automaton would have to read
every later document, which grows with the square of the corpus; hence the anchors (see README).

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; rows that share an id
are versions of one document, each with places from 0: a window that starts at the same place in two of them is one
window, so equal rows of one id keep their words, and further on it is a repeat; null ids are one such id, after all others; an empty table gives an empty result;
extra columns are not looked at. Very long texts are read whole, each in one batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import BYTE_BACK, BYTE_STEP, WORD_BACK, WORD_STEP, Sums, bounds, per_worker, slim_batches, words
from chronoloom.llm.tables import release, stored

LENGTH, ANCHOR = 20, 8
PLACE_BITS = 24
#: Stands for a null id: after all others.
NO_ID = (1 << 63) - 1


def _anchored(column, length: int, of_bytes: Sums, of_words: Sums):
    """The words of a batch, the windows' first words, and the anchor of each window with the anchors' hashes."""
    hashes, row, start, end, data = words(column, sums=of_bytes)
    n = len(hashes)
    if n < length:
        none = np.zeros(0, np.int64)
        return hashes, row, start, end, data, none, none, hashes[:0]
    at = np.flatnonzero(row[: n - length + 1] == row[length - 1 :])
    first = np.arange(n - ANCHOR + 1)
    gram = of_words(hashes, first, first + ANCHOR)
    # The hash's upper bits with the place below them: the smallest is the leftmost of the smallest.
    key = (gram >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | first.astype(np.uint64) & np.uint64((1 << PLACE_BITS) - 1)
    width, span = length - ANCHOR + 1, 1
    while span < width:
        step = min(span, width - span)
        key = np.minimum(key[: len(key) - step], key[step:])
        span += step
    low = key[at] & np.uint64((1 << PLACE_BITS) - 1)
    anchor = at + ((low - at.astype(np.uint64)) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return hashes, row, start, end, data, at, anchor, gram


def _sums():
    return per_worker("sums", lambda: (Sums(BYTE_STEP, BYTE_BACK), Sums(WORD_STEP, WORD_BACK)))


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(hash, doc_id, place) of each anchor; place counts the document's words from 0."""

    def made(parts):
        for batch in parts:
            _, row, _, _, _, _, anchor, gram = _anchored(batch.column(1), length, *_sums())
            anchor = np.unique(anchor)
            ids, first = np.asarray(batch.column(0)), bounds(row, batch.num_rows)
            r = row[anchor]
            yield pa.RecordBatch.from_arrays([pa.array(gram[anchor].view(np.int64)), pa.array(ids[r], pa.int64()), pa.array((anchor - first[r]).astype(np.int32))], names=["hash", "doc_id", "place"])

    return docs.mapInArrow(made, "hash long, doc_id long, place int")


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, anchors: places of the anchors whose hash occurs elsewhere too); stored. The repeated hashes are stored
    first, so that the join is between two tables and Spark may split the rows of a frequent hash."""
    every = stored(anchors(docs, length))
    twice = stored(every.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"))
    return stored(every.join(twice, "hash").groupBy("doc_id").agg(F.collect_set("place").alias("anchors")), every, twice)


def _on_repeated(batch, length: int, of_bytes: Sums, of_words: Sums):
    """The batch's words, and the windows on the anchors listed in its third column."""
    hashes, row, start, end, data, at, anchor, _ = _anchored(batch.column(1), length, of_bytes, of_words)
    first = bounds(row, batch.num_rows)
    hit = np.zeros(len(hashes) + 1, bool)
    for i, places in enumerate(batch.column(2)):
        if places.is_valid:
            p = first[i] + np.asarray(places.values)
            hit[p[p < first[i + 1]]] = True
    return hashes, row, start, end, data, at[hit[anchor]], first


def first_windows(docs: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """(doc_id, firsts: places of the windows, among those on repeated anchors, that are the first of their words)."""

    def made(parts):
        for batch in parts:
            of_bytes, of_words = _sums()
            hashes, row, _, _, _, at, first = _on_repeated(batch, length, of_bytes, of_words)
            ids, r = np.asarray(batch.column(0)), row[at]
            yield pa.RecordBatch.from_arrays([pa.array(of_words(hashes, at, at + length).view(np.int64)), pa.array(ids[r], pa.int64()), pa.array((at - first[r]).astype(np.int32))], names=["hash", "doc_id", "place"])

    found = docs.join(repeated, "doc_id").select("doc_id", "text", "anchors").mapInArrow(made, "hash long, doc_id long, place int")
    # One number orders document and place; as a decimal it is aggregated in place, without sorting.
    order = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("place")
    least = found.groupBy("hash").agg(F.min(order.cast("decimal(38,0)")).alias("o"))
    big = F.lit(1 << 31).cast("decimal(11,0)")
    place = F.pmod("o", big).cast("int")
    return least.select(((F.col("o") - F.pmod("o", big)) / big).cast("decimal(20,0)").cast("long").alias("doc_id"), place.alias("place")).groupBy("doc_id").agg(F.collect_list("place").alias("firsts"))


def substring_dedup(docs: DataFrame, length: int = LENGTH, keep_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed (words in a window of `length` words whose words also start earlier: in a
    document of a smaller id, or earlier in the same one), kept_sha256 (of the kept words, joined by one space), and
    spans, the removed stretches (first word, words). keep_text adds the kept words as text. Windows are judged on the
    input."""
    slim_batches(docs.sparkSession)
    slim = docs.selectExpr(f"coalesce(cast(`{id_col}` as bigint), {NO_ID}L) as doc_id", f"`{text_col}` as text")
    repeated = repeated_anchors(slim, length)
    firsts = stored(first_windows(slim, repeated, length))
    release(docs.sparkSession)
    span = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))

    def made(parts):
        for batch in parts:
            _, row, start, end, data, at, first = _on_repeated(batch, length, *_sums())
            is_first = np.zeros(len(row) + 1, bool)
            for i, places in enumerate(batch.column(3)):
                if places.is_valid:
                    p = first[i] + np.asarray(places.values)
                    is_first[p[p < first[i + 1]]] = True
            again = at[~is_first[at]]
            depth = np.zeros(len(row) + 1, np.int64)
            np.add.at(depth, again, 1)
            np.add.at(depth, again + length, -1)
            gone = np.cumsum(depth)[:-1] > 0
            raw = data.tobytes()
            out = [[], [], [], [], []]
            for i in range(batch.num_rows):
                a, b = first[i], first[i + 1]
                g = gone[a:b]
                kept = b" ".join([raw[x:y] for x, y in zip(start[a:b][~g].tolist(), end[a:b][~g].tolist(), strict=True)])
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]])))
                spans = [{"first": int(x), "words": int(y - x)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
                for column, value in zip(out, (int(b - a), int(g.sum()), hashlib.sha256(kept).hexdigest(), spans, kept.decode()), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), span, pa.string()][: 4 + keep_text]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out[: 4 + keep_text], kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "text"][: 5 + keep_text])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first long, words long>>" + ", text string" * keep_text
    out = slim.join(repeated, "doc_id", "left").join(firsts, "doc_id", "left").select("doc_id", "text", "anchors", "firsts").mapInArrow(made, schema)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
