"""Spelling variants: words one edit apart, found by reduced-alphabet generation.

Letters are hashed to a few symbols. If two words differ by one inserted, deleted or replaced code point, their reduced
words differ by one such edit or are equal; so the full one-edit neighbourhood of one reduced word (itself, every
deletion, replacement and insertion over the symbols) holds the other. Neighbourhoods, as 32-bit hashes that are made
for many words at once from running sums, are joined with the hashes of the reduced vocabulary; every pair that meets is
verified on the original words. Neither a low count nor a full bucket ends the search: all pairs are found. Members that
no word can have are passed over before the join, by a bitmap of the vocabulary's hashes that has 2**BITS bits whatever
the vocabulary (8 MB, the one thing that is broadcast): the fuller it is, the fewer it keeps from the join.

The alphabet has SYMBOLS[0] symbols for pairs whose shorter word has under 16 code points, fewer for longer words, whose
many places tell them apart as it is: a neighbourhood has about twice as many members as the word has code points times
symbols. A vocabulary of a billion words wants more symbols, so that candidates stay few: a parameter.

A word's form is its near word of largest n (of these the smallest in code-point order) if that n is at least `ratio`
times its own; roots follow forms to their end. As n grows by the ratio with each step, chains are short; they are
halved by pointer jumping, a join a round.

Defined results: a null text has no word; a null id is taken as the empty string where runs are hashed; repeated rows
count again; very long runs are words like others (memory holds one word's neighbourhood, a few dozen bytes a code
point); an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import BYTE_BACK, BYTE_STEP, mixed, powers, slim_batches
from chronoloom.llm.tables import stored

LETTERS, LEAST, DROP = r"[A-Za-zÀ-ÿ]", 7, 31
#: Code points of a pair's shorter word from which an alphabet holds, and its symbols.
BANDS, SYMBOLS = (0, 16, 32), (8, 4, 2)
#: Array elements (words x places x symbols) made at once; bits of the bitmap's size, and of one of its pieces.
MOST, BITS, PIECE = 1 << 21, 26, 15


def counted_words(docs: DataFrame, least: int = LEAST, drop: int = DROP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all runs of letters, lower case for A-Z, of which about one in `drop` loses a code point that the
    hash of its document and itself picks; words of at least `least` code points and two occurrences."""
    upper = "".join(map(chr, range(65, 91)))
    # A shorter run stays too short.
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.explode(F.regexp_extract_all(text_col, F.lit(LETTERS + f"{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("i", F.translate("run", upper, upper.lower()).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("i", F.lit(":"), "run").cast("binary")))
    word = F.when(F.col("h") % drop == 0, F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2")


def symbol(codes: np.ndarray, n: int) -> np.ndarray:
    """The symbol, from 1 to n, of each code point."""
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(12)) % np.uint64(n) + np.uint64(1)


class Reduced:
    """Hashes of the reduced forms of words of one length, given as a matrix of code points, and of what is one edit
    away. A hash is a polynomial of the symbols; an edit changes a prefix sum, a suffix sum or one term."""

    def __init__(self, codes: np.ndarray, symbols: int):
        self.s, self.n = symbol(codes, symbols), symbols
        self.up = powers(BYTE_STEP, codes.shape[1] + 2)
        self.before = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        np.cumsum(self.s * self.up[: codes.shape[1]], axis=1, out=self.before[:, 1:])
        self.whole = self.before[:, -1:]

    def key(self, x: np.ndarray) -> np.ndarray:
        """32 bits; words reduced by different alphabets do not meet."""
        return (mixed(x + np.uint64(self.n << 40)) >> np.uint64(32)).astype(np.uint32).view(np.int32).reshape(len(self.s), -1)

    def itself(self) -> np.ndarray:
        return self.key(self.whole)

    def deletions(self) -> np.ndarray:
        return self.key(self.before[:, :-1] + (self.whole - self.before[:, 1:]) * np.uint64(BYTE_BACK))

    def replacements(self) -> np.ndarray:
        new = np.arange(1, self.n + 1, dtype=np.uint64)
        return self.key(self.whole[:, :, None] + (new - self.s[:, :, None]) * self.up[: self.s.shape[1], None])

    def insertions(self) -> np.ndarray:
        new = np.arange(1, self.n + 1, dtype=np.uint64)
        moved = self.before + (self.whole - self.before) * np.uint64(BYTE_STEP)
        return self.key(moved[:, :, None] + new * self.up[: moved.shape[1], None])


def alphabet(length: int, symbols: tuple[int, ...] = SYMBOLS) -> int:
    """The symbols that hold for pairs whose shorter word has `length` code points."""
    return symbols[sum(length >= b for b in BANDS) - 1]


def neighbourhood(codes: np.ndarray, symbols: tuple[int, ...] = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """For words of one length: the row and key of each distinct member of their neighbourhoods. What is deleted from a
    word meets shorter words, which tell the alphabet."""
    length = codes.shape[1]
    own = Reduced(codes, alphabet(length, symbols))
    less = own if alphabet(length - 1, symbols) == own.n else Reduced(codes, alphabet(length - 1, symbols))
    keys = np.sort(np.concatenate([own.itself(), less.deletions(), own.replacements(), own.insertions()], axis=1), axis=1)
    first = np.ones(keys.shape, bool)
    np.not_equal(keys[:, 1:], keys[:, :-1], out=first[:, 1:])
    return np.nonzero(first)[0], keys[first]


def vocabulary_keys(codes: np.ndarray, symbols: tuple[int, ...] = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """Where words of one length are met: under their own alphabet, and under that of words shorter by one, if another."""
    length = codes.shape[1]
    kinds = {alphabet(length, symbols), alphabet(length - 1, symbols)}
    keys = [Reduced(codes, n).itself()[:, 0] for n in sorted(kinds)]
    return np.tile(np.arange(len(codes)), len(keys)), np.concatenate(keys)


def bitmap(keyed: DataFrame) -> np.ndarray:
    """The bits that keys have, a key's by its first BITS bits, as bytes; a byte's lowest bit counts first."""
    place = F.shiftrightunsigned("key", 32 - BITS)
    pieces = keyed.groupBy(F.shiftrightunsigned(place, PIECE).alias("piece")).agg(F.bitmap_construct_agg((place.bitwiseAND((1 << PIECE) - 1)).cast("long")).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in pieces.collect():
        out[r["piece"] << (PIECE - 3) :][: 1 << (PIECE - 3)] = np.frombuffer(r["bits"], np.uint8)
    return out


def _keyed(words: DataFrame, make, schema: str, symbols: tuple[int, ...], bits=None) -> DataFrame:
    """Rows of words (word first), each once for every key that make gives it, key first; with a broadcast bitmap, for
    those alone that it has."""
    fields = [("key", pa.int32()), ("word", pa.string()), ("n", pa.int64())][: schema.count(",") + 1]

    def rows(parts):
        for batch in parts:
            text = batch.column(0).to_pylist()
            length = np.array([len(t) for t in text], np.int64)
            for size in np.unique(length):
                own = np.flatnonzero(length == size)
                step = max(1, MOST // (int(size) * max(symbols)))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    codes = np.frombuffer("".join([text[i] for i in some]).encode("utf-32-le"), np.uint32).reshape(len(some), size)
                    row, key = make(codes, symbols)
                    if bits is not None:
                        place = key.view(np.uint32) >> np.uint32(32 - BITS)
                        there = np.flatnonzero(bits.value[place >> np.uint32(3)] >> (place & np.uint32(7)).astype(np.uint8) & np.uint8(1))
                        row, key = row[there], key[there]
                    place = pa.array(some[row])
                    yield pa.RecordBatch.from_arrays([pa.array(key)] + [batch.column(c).take(place) for c in range(len(fields) - 1)], schema=pa.schema(fields))

    return words.mapInArrow(rows, schema)


def near_pairs(words: DataFrame, symbols: tuple[int, ...] = SYMBOLS) -> DataFrame:
    """words (word, n) to (word, near, n: of near): every two words one edit apart, both ways, and each word with itself."""
    slim_batches(words.sparkSession)
    met = _keyed(words, vocabulary_keys, "key int, near string, n long", symbols)
    around = _keyed(words, neighbourhood, "key int, word string", symbols, words.sparkSession.sparkContext.broadcast(bitmap(met)))
    return around.join(met, "key").filter((F.col("word") == F.col("near")) | (F.levenshtein("word", "near", 1) == 1)).select("word", "near", "n")


def with_forms(words: DataFrame, ratio: int = 10, symbols: tuple[int, ...] = SYMBOLS) -> DataFrame:
    """words (word, n) to (word, n, n_near, form, form_n)."""
    near = F.col("word") != F.col("near")
    # Each word meets itself, which brings its own n; the largest struct of (n, no less than no word) is the form.
    least = F.min(F.when(near, F.struct((-F.col("n")).alias("less"), F.col("near").alias("near")))).alias("best")
    out = near_pairs(words, symbols).groupBy("word").agg(F.max(F.when(~near, F.col("n"))).alias("n"), F.count_if(near).alias("n_near"), least)
    has = -F.col("best.less") >= ratio * F.col("n")
    return out.select("word", "n", "n_near", F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """forms (word, form), each with a form, to (word, root): the last of the chain. Chains are halved each round."""
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        next_ = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        both = stored(reached.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), reached)
        reached = both.select("word", "root")
        if both.filter("moved").isEmpty():
            return reached
        reached.stored_at = both.stored_at


def spelling_variants(docs: DataFrame, ratio: int = 10, least: int = LEAST, drop: int = DROP, symbols: tuple[int, ...] = SYMBOLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: word, n, n_near (words one edit away), form and form_n (see above), root (the word itself without a form)."""
    spark = docs.sparkSession
    words = stored(counted_words(docs, least, drop, id_col, text_col))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(with_forms(words.repartition(parts, "word"), ratio, symbols), words)
    root = roots(found.filter("form is not null"))
    return found.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))
