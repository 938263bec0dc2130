"""Words of whole Arrow text columns, and hashes of words and word windows, computed on arrays without a loop over words.

A batch is small (see `slim_batches`), so that the arrays here stay within tens of MB whatever the texts' length, but
for a single text longer than that. Offsets of string columns are 32-bit ones; `utf8` refuses others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd multipliers (of a word's bytes, of a window's words), their inverses modulo 2**64, and constants of the mixer. Fixed values.
BYTE_STEP, WORD_STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
BYTE_BACK, WORD_BACK = (pow(x, -1, 2**64) for x in (BYTE_STEP, WORD_STEP))
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def slim_batches(spark) -> None:
    """Arrow batches by bytes: about a MB of texts, or one larger text, whatever the number of rows. All operators here
    set the same values, so that a lazy frame built before another operator ran gets the batches it was made for."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20_000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null being empty, and where each row starts and the last ends."""
    if column.type not in (pa.string(), pa.binary()):
        raise TypeError(f"a column with 32-bit offsets is wanted, not {column.type}")
    column = column.fill_null("") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def powers(step: int, n: int) -> np.ndarray:
    """step**0 to step**(n-1) modulo 2**64."""
    out = np.full(n, step, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Sums:
    """Hashes of stretches of an array: the polynomial of a stretch is a difference of running sums, moved back to its start."""

    def __init__(self, step: int, back: int):
        self.step, self.back, self.up, self.down = step, back, powers(step, 1 << 16), powers(back, 1 << 16)

    def __call__(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(values) + 1 > len(self.up):
            n = max(len(values) + 1, 2 * len(self.up))
            self.up, self.down = powers(self.step, n), powers(self.back, n)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=total[1:])
        return mixed((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))


def words(column, space: np.ndarray = SPACE, lower: bool = False, sums: Sums | None = None):
    """The words of all rows: 64-bit hashes, row numbers, first bytes and ends in `data`, and data itself. space marks
    the bytes between words."""
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(space[data], out=inside[1:-1])
    edge = np.zeros(len(data) + 1, bool)  # a row ends a word
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    row = np.searchsorted(offsets, start, side="right") - 1
    return (sums or Sums(BYTE_STEP, BYTE_BACK))(data.astype(np.uint64) + np.uint64(1), start, end), row, start, end, data


def windows(hashes: np.ndarray, row: np.ndarray, k: int, sums: Sums | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of k words that lie in one row, and the place of each window's first word."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1 :])
    return (sums or Sums(WORD_STEP, WORD_BACK))(hashes, at, at + k), at


def bounds(row: np.ndarray, n: int) -> np.ndarray:
    """For sorted row numbers, where each of n rows starts and the last ends."""
    return np.searchsorted(row, np.arange(n + 1))


def per_worker(key: str, make):
    """What make() gives, made once in each Python worker."""
    import sys

    kept = sys.__dict__.setdefault("_chronoloom", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
