"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document if at least `percent` per cent of its distinct k-word shingles are shingles of the
document. Items are short and documents long, so resemblance of the two says little; hence

1. a document is reduced to its shingles that some item has, which changes no containment;
2. reduced documents fall into partitions by size, each with an upper bound u. In a partition, an item of q shingles at
   the threshold resembles the reduced document by at least need / (u + q - need). For that resemblance the longest bands
   of min-wise values are taken with which a pair is missed at most MISS times;
3. items that share a band with the document are candidates, and each is verified by its exact containment;
4. where not even bands of one value are so safe, as in documents with shingles of many items, the shared shingles of
   each item are counted exactly, from an index of the items that have a shingle.

Items go to the executors in blocks of at most MOST_SHINGLES shingles: a larger benchmark is searched block by block,
each over all documents.

Words are split at ASCII white space after A-Z are lower-cased. Defined results: an item with fewer words than k is one
shingle of all its words, an item without words, or null, is in no document; a null or empty document holds nothing;
repeated rows and repeated items are each reported; empty tables give an empty result; extra columns are not looked at.
Very long texts are read whole.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import BYTE_BACK, BYTE_STEP, WORD_BACK, WORD_STEP, Sums, bounds, mixed, per_worker, slim_batches, windows, words

VALUES, MISS, MOST_SHINGLES, MAP_BITS = 128, 1e-6, 2_000_000, 24
STEPS = mixed(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)


def _sums():
    return per_worker("sums", lambda: (Sums(BYTE_STEP, BYTE_BACK), Sums(WORD_STEP, WORD_BACK)))


def item_shingles(column, k: int) -> list[tuple[int, np.ndarray]]:
    """(words in a shingle, sorted distinct hashes) of each item."""
    of_bytes, of_words = _sums()
    hashes, row, *_ = words(column, lower=True, sums=of_bytes)
    at = bounds(row, len(column))
    out = []
    for i in range(len(column)):
        own = hashes[at[i] : at[i + 1]]
        size = min(k, len(own))
        start = np.arange(len(own) - size + 1) if size else np.zeros(0, np.int64)
        out.append((size, np.unique(of_words(own, start, start + size))))
    return out


def least_values(shingles: np.ndarray) -> np.ndarray:
    return (shingles[None, :] * STEPS[:, None]).min(1)


def band_rows(resemblance: float) -> int:
    """The most values in a band with which a pair of this resemblance is missed at most MISS times; 0 if none is so safe."""
    fit = [r for r in (8, 4, 2, 1) if (1 - resemblance**r) ** (VALUES // r) <= MISS]
    return fit[0] if fit else 0


def bands(least: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band of `rows` values."""
    key = np.zeros(VALUES // rows, np.uint64)
    for j in range(rows):
        key = mixed(key * np.uint64(WORD_STEP) + least[j::rows][: len(key)])
    return key


class Items:
    """A block of items, indexed by their bands."""

    def __init__(self, ids: list[int], sets: list[tuple[int, np.ndarray]], percent: int):
        kept = [i for i, (_, s) in enumerate(sets) if len(s)]
        self.ids, self.sets, self.percent = [ids[i] for i in kept], [sets[i][1] for i in kept], percent
        self.lengths = np.array([len(x) for x in self.sets], np.int64)
        self.sizes = sorted({sets[i][0] for i in kept})
        self.all = np.unique(np.concatenate(self.sets)) if kept else np.zeros(0, np.uint64)
        #: the items that have the shingle all[i]: owners[at[i]:at[i + 1]]
        shingles = np.concatenate(self.sets) if kept else np.zeros(0, np.uint64)
        owners = np.repeat(np.arange(len(self.sets), dtype=np.int32), [len(x) for x in self.sets])
        order = np.argsort(shingles, kind="stable")
        self.owners, self.at = owners[order], np.append(np.searchsorted(shingles[order], self.all), len(shingles))
        self.map = np.zeros(1 << MAP_BITS, bool)
        self.map[(self.all >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True
        #: items by size class, and for each class and band length the items of each band key
        self.classes: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            self.classes.setdefault(len(s).bit_length(), []).append(i)
        self.least = [least_values(s) for s in self.sets]
        self.index: dict[tuple[int, int], dict[int, list[int]]] = {}
        self.bounds: dict[tuple[int, int], float] = {}

    def table(self, size_class: int, rows: int) -> dict[int, list[int]]:
        if (size_class, rows) not in self.index:
            made = self.index[size_class, rows] = {}
            for i in self.classes[size_class]:
                for j, key in enumerate(bands(self.least[i], rows).tolist()):
                    made.setdefault(key ^ j, []).append(i)
        return self.index[size_class, rows]

    def reduced(self, shingles: np.ndarray) -> np.ndarray:
        """Which of the shingles some item has."""
        maybe = np.flatnonzero(self.map[(shingles >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.all, shingles[maybe]), len(self.all) - 1)
        return maybe[self.all[place] == shingles[maybe]]

    def shared(self, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The items that share a shingle with a reduced document, and how many each shares."""
        place = np.searchsorted(self.all, document)
        n = self.at[place + 1] - self.at[place]
        each = np.repeat(self.at[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.unique(self.owners[each], return_counts=True)

    def resemblance(self, size_class: int, upper: int) -> float:
        """The least resemblance at the threshold of any size in the class and a reduced document of upper shingles."""
        if (size_class, upper) in self.bounds:
            return self.bounds[size_class, upper]
        needs = ((q, -(-q * self.percent // 100)) for q in range(1 << (size_class - 1), 1 << size_class))
        self.bounds[size_class, upper] = min(need / (upper + q - need) for q, need in needs)
        return self.bounds[size_class, upper]

    def found(self, document: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, shared, shingles of the item) of the items that a reduced document, sorted and distinct, contains."""
        least, upper, out, counted = least_values(document), 1 << (len(document) - 1).bit_length(), [], None
        for size_class in self.classes:
            rows = band_rows(min(1.0, self.resemblance(size_class, upper)))
            if not rows:
                counted = self.shared(document) if counted is None else counted
                own = (len_of := self.lengths[counted[0]]) >> (size_class - 1) == 1
                out += [(i, n, q) for i, n, q in zip(*(x[own].tolist() for x in (*counted, len_of)), strict=True) if 100 * n >= self.percent * q]
                continue
            table, seen = self.table(size_class, rows), set()
            for j, key in enumerate(bands(least, rows).tolist()):
                seen.update(table.get(key ^ j, ()))
            for i in sorted(seen):
                shared = int(np.isin(self.sets[i], document, assume_unique=True).sum())
                if 100 * shared >= self.percent * len(self.sets[i]):
                    out.append((i, shared, len(self.sets[i])))
        return out

    def __call__(self, column) -> list[list[tuple[int, int, int]]]:
        """For each document of a batch, the items in it."""
        of_bytes, of_words = _sums()
        hashes, row, *_ = words(column, lower=True, sums=of_bytes)
        out, hits = [[] for _ in range(len(column))], []
        for k in self.sizes:
            grams, at = windows(hashes, row, k, of_words)
            some = self.reduced(grams)
            hits.append((row[at[some]], grams[some]))
        if not hits:
            return out
        at, grams = (np.concatenate(x) for x in zip(*hits, strict=True))
        for i in np.unique(at).tolist():
            out[i] = self.found(np.unique(grams[at == i]))
        return out


def _blocks(items: DataFrame, k: int, percent: int, id_col: str, text_col: str):
    """Broadcast blocks of items, each of at most about MOST_SHINGLES shingles: (name, ids, words in a shingle, where each
    item's sorted hashes begin and the last end, hashes)."""
    slim = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = slim.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    blocks = total // MOST_SHINGLES + 1
    for b in range(blocks):
        block = slim.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).toArrow()
        column = block.column(1).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
        sets = item_shingles(column, k) if len(block) else []
        # Plain arrays are sent, which workers unpack without this package; the index over them is made there, once.
        sent = (uuid.uuid4().hex, block.column(0).to_pylist(), [size for size, _ in sets], np.cumsum([0, *[len(x) for _, x in sets]]), np.concatenate([x for _, x in sets]) if sets else np.zeros(0, np.uint64))
        yield items.sparkSession.sparkContext.broadcast(sent)


def _unpacked(sent: tuple, percent: int) -> Items:
    """The block's index, made once in a worker, which keeps no earlier block's."""
    kept, (key, ids, sizes, at, shingles) = per_worker("items", dict), sent
    if key not in kept:
        kept.clear()
        kept[key] = Items(ids, [(size, shingles[a:b]) for size, a, b in zip(sizes, at[:-1], at[1:], strict=True)], percent)
    return kept[key]


def contaminated(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and item that it contains: doc_id, item_id, n_shared, n_item (shingles), containment."""
    spark = docs.sparkSession
    slim_batches(spark)
    slim = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    out = None
    for sent in _blocks(items, k, percent, item_id, item_text):

        def searched(parts, sent=sent):
            block = _unpacked(sent.value, percent)
            for batch in parts:
                rows = [(d, block.ids[i], shared, n) for d, met in zip(batch.column(0).to_pylist(), block(batch.column(1)), strict=True) for i, shared, n in met]
                if rows:
                    doc, item, shared, n = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(shared, pa.int64()), pa.array(n, pa.int64()), pa.array([a / b for a, b in zip(shared, n, strict=True)])], names=["doc_id", "item_id", "n_shared", "n_item", "containment"])

        found = slim.mapInArrow(searched, "doc_id long, item_id long, n_shared long, n_item long, containment double")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that contain no item. One pass for each block of items, no shuffle."""
    slim_batches(docs.sparkSession)
    place = docs.columns.index(text_col)
    for sent in _blocks(items, k, percent, item_id, item_text):

        def kept(parts, sent=sent):
            block = _unpacked(sent.value, percent)
            for batch in parts:
                yield batch.filter(pa.array([not met for met in block(batch.column(place))], pa.bool_()))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs
