"""Token counts of every prefix of a text, by dynamic programming over the pieces of a byte-pair vocabulary.

The encoding of a prefix ends in one piece, and what comes before it is the encoding of a shorter prefix: so the count
of a prefix is one more than the count of that shorter prefix. The last piece is the longest vocabulary piece that
ends the prefix and stands beside the last piece of the shorter prefix without a merge. Pieces never hold white space
but at their start, so the table is built for each distinct unit (a word with the spaces before it) once a worker, and
a text's table is the tables of its units set one after another.

The stored table has a signed byte for each character: how the count changes from the prefix before. Its running sum
answers how many tokens a prefix has, and how far a budget reaches, without encoding again.

Defined results: null and empty texts have no token; very long texts are handled unit by unit, units beyond
MOST_KEPT characters are not remembered; repeated rows are counted each; an empty table gives an empty result; extra
columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoloom.llm.hashing import per_worker, slim_batches, utf8

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
MOST_KEPT, MOST_UNITS = 64, 300_000


class PrefixCounts:
    """Prefix tables for a sentencepiece byte-pair model with byte fallback."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        sp, n = self.sp, self.sp.get_piece_size()
        self.pieces = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.names = {i: p for p, i in self.pieces.items()}
        self.stand: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: lengths over 1 of the pieces that end in two characters, longest first
        ends: dict[str, set[int]] = {}
        for p in self.pieces:
            if len(p) > 1:
                ends.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {c: tuple(sorted(x, reverse=True)) for c, x in ends.items()}

    def stands(self, left: int, right: int) -> bool:
        """Whether the two pieces set side by side are encoded as these two."""
        if len(self.stand) >= 2 * MOST_UNITS:
            self.stand.clear()
        # A line feed is in no piece: it keeps the mark for a text's start away from the two.
        known = self.stand[left << 32 | right] = self.sp.encode("\n" + self.names[left] + self.names[right])[2:] == [left, right]
        return known

    def table(self, unit: str) -> bytes:
        """The change of the count at each character of a unit."""
        get, stand, lengths, n = self.pieces.get, self.stand.get, self.lengths.get, len(unit)
        count, last = [0] * (n + 1), [0] * (n + 1)  # 0: no piece, with which nothing merges
        for j in range(1, n + 1):
            for size in lengths(unit[j - 2 : j], ()) if j > 1 else ():
                if size > j or (piece := get(unit[j - size : j])) is None:
                    continue
                before = last[j - size]
                if not before or (stand(before << 32 | piece) if (before << 32 | piece) in self.stand else self.stands(before, piece)):
                    count[j], last[j] = count[j - size] + 1, piece
                    break
            else:
                c = unit[j - 1]
                last[j] = get(c, 0)
                count[j] = count[j - 1] + (1 if last[j] else len(c.encode("utf-8", "surrogatepass")))
        return bytes([(count[j + 1] - count[j]) & 255 for j in range(n)])

    def __call__(self, text: str) -> bytes:
        """A signed byte for each character of the text, and one more, the first, for the mark that its start gets."""
        if not text:
            return b""
        units = UNIT.findall(SPACE + text.replace(" ", SPACE))
        out = list(map(self.units.get, units))
        for i, found in enumerate(out):
            if found is None:
                unit = units[i]
                out[i] = found = self.units.get(unit) or self.older.get(unit) or self.table(unit)
                if len(unit) <= MOST_KEPT:
                    if len(self.units) >= MOST_UNITS:  # units not met again since the last turn go
                        self.older, self.units = self.units, {}
                    self.units[unit] = found
        return b"".join(out)


def tokens_at(table: bytes, n_chars: int) -> int:
    """Tokens of the first n_chars characters; of no character, none."""
    return int(np.frombuffer(table, np.int8)[: n_chars + 1].sum(dtype=np.int64)) if n_chars else 0


def chars_within(table: bytes, budget: int) -> int:
    """The most characters of a prefix of at most budget tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64)[1:] <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(docs: DataFrame, model: str, budget: int = 4096, keep_tables: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > budget) and fit_chars, the most characters of a
    prefix within the budget. keep_tables adds prefix_counts (binary), to be read by tokens_at and chars_within. model
    is a path that each executor can read."""
    slim_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("fit_chars", pa.int64())] + [("prefix_counts", pa.binary())] * keep_tables)

    def counted(parts):
        tables = per_worker(f"prefix {model}", lambda: PrefixCounts(model))
        for batch in parts:
            size = np.diff(utf8(batch.column(1))[1])
            made = [tables(x.as_py() or "") for x in batch.column(1)]
            n = [int(np.frombuffer(x, np.int8).sum(dtype=np.int64)) for x in made]
            fit = [max(len(x) - 1, 0) if k <= budget else chars_within(x, budget) for x, k in zip(made, n, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([k > budget for k in n]), pa.array(fit, pa.int64())] + [pa.array(made, pa.binary())] * keep_tables, schema=schema)

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + ", prefix_counts binary" * keep_tables)
