"""Byte-pair encoding by speculation and verification, and decoding.

A text is cut into units as the vocabulary's pre-tokenizer cuts it. For every unit that a worker has not met, greedy
longest match proposes tokens. A sequence of tokens is the byte-pair encoding of its bytes exactly if each two that stand
side by side are the encoding of theirs; so all adjacent pairs of all proposals of a batch are tested at once, as arrays:
the merges that made the two tokens are undone from the last back, and at each state of the seam between them the merge
across it, if there is one, must come later than what happened next to it. Units with a pair that fails are merged
exactly, in order of rank. The tables of the test come from the merges alone.

Units are remembered in two generations, so that memory is bounded; a text's ids are those of its units in a row.
Decoding sets the tokens' bytes one after another and reads them as UTF-8, with the replacement character for what is none.

The pre-tokenizer's classes of characters (letters, numbers, white space, others) are Unicode's of the library's version.
They are taken from Python's tables and asked of the library the first time that a worker meets a character beyond ASCII.

Defined results: a null or empty text has no id and decodes to the empty string; very long texts are taken whole, units
beyond MOST_KEPT characters are not remembered; strings of special tokens in a text are such tokens; repeated rows are
encoded each; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoloom.llm.hashing import per_worker, slim_batches

MOST_KEPT, MOST_UNITS = 64, 300_000
#: Contractions that are units, and white space beyond the ASCII one, as the pre-tokenizer's pattern has them. Fixed values.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
ASCII_SPACE = "\t\n\x0b\x0c\r "
NEVER = np.int64(1) << 60


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}


def _class(chars: list[str]) -> str:
    """A regular expression's class of the characters, as ranges."""
    codes = np.unique([ord(c) for c in chars])
    cuts = np.flatnonzero(np.diff(codes) > 1)
    first, last = codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


class Units:
    """Cuts texts as the library's byte-level pre-tokenizer does."""

    def __init__(self, library):
        self.library = library
        self.kinds = {"L": [], "N": [], "Z": []}
        for code in range(sys.maxunicode + 1):
            kind = unicodedata.category(chr(code))[0]
            if kind in self.kinds and (kind != "Z" or code > 127):
                self.kinds[kind].append(chr(code))
        self.kinds["Z"] += [*ASCII_SPACE, "\x85"]
        self.known = {kind: set(chars) for kind, chars in self.kinds.items()}
        self.seen: set[str] = set(map(chr, range(128)))
        self.ascii = self.pattern(lambda c: c < "\x80")
        self.low = self.high = None

    def pattern(self, chosen) -> re.Pattern:
        letter, number, space = (_class([c for c in self.known[k] if chosen(c)]) for k in "LNZ")
        return re.compile(f"{'|'.join(ENDINGS)}| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")

    def kind(self, char: str) -> str:
        """Asks the library which characters stay in one unit with this one."""
        for with_, kind in (("a", "L"), ("1", "N"), ("!", "")):
            if len(self.library.pre_tokenize_str(with_ + char)) == 1:
                return kind
        return "Z"

    def meet(self, chars: set[str]) -> None:
        for char in chars - self.seen:
            self.seen.add(char)
            kind = self.kind(char)
            if any((char in own) != (k == kind) for k, own in self.known.items()):
                for k, chars in self.known.items():
                    (chars.add if k == kind else chars.discard)(char)
                self.low = self.high = None

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        chars = set(text)
        self.meet(chars)
        if max(chars) < "\U00010000":  # classes beyond the first plane are slow to search
            self.low = self.low or self.pattern(lambda c: c < "\U00010000")
            return self.low.findall(text)
        self.high = self.high or self.pattern(lambda c: True)
        return self.high.findall(text)


class BytePairs:
    """A byte-level byte-pair vocabulary: ids of texts, texts of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.units = Units(Tokenizer.from_file(path).pre_tokenizer)
        with open(path) as f:
            stored = json.load(f)
        as_byte, model = byte_of(), stored["model"]
        vocab = {bytes(as_byte[c] for c in t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes = [b""] * self.size
        for t, i in [*vocab.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes[i] = t
        #: ids of the pair to (rank, id of the merge)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (bytes(as_byte[c] for c in part) for part in (merge if isinstance(merge, list) else merge.split(" ")))
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.single = [vocab[bytes([b])] for b in range(256)]
        pairs = np.array([a * self.size + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self.pair, self.pair_rank = pairs[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self._split()
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _split(self) -> None:
        """For each token the two it is merged from and when; tokens that their own bytes do not give are not proposed."""
        self.left, self.right, self.made = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        for (a, b), (rank, i) in self.merges.items():
            if self.made[i] < 0:
                self.left[i], self.right[i], self.made[i] = a, b, rank
        whole, order = set(self.single), np.argsort(self.made)
        order = order[self.made[order] >= 0]
        two = self.compatible(self.left[order], self.right[order], self.made[order])
        for i, a, b, fits in zip(order.tolist(), self.left[order].tolist(), self.right[order].tolist(), two.tolist(), strict=True):
            if fits and a in whole and b in whole:
                whole.add(i)
        self.tokens = {self.bytes[i]: i for i in whole}
        ends: dict[bytes, set[int]] = {}
        for t in self.tokens:
            if len(t) > 1:
                ends.setdefault(t[:2], set()).add(len(t))
        self.lengths = {t: tuple(sorted(x, reverse=True)) for t, x in ends.items()}

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, NEVER if there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether each two tokens stay two when their bytes are encoded together (until their own merge, of that rank).

        x and y are what touches the seam, from when the later of them is made until the earlier of their own next
        merges. A merge of x and y within that time, or at its end if it stands to the left of what ends it, joins them.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        # The next merge that takes x, with what stands left of it, and y, with what stands right of it.
        x_until = y_until = np.full(len(a), NEVER) if until is None else until
        while len(live):
            rank = self.rank_of(x, y)
            # Of equal ranks the one further left goes first: x's merge with its left comes before, y's with its right after.
            joined = (rank < x_until) & (rank <= y_until) & (rank < NEVER)
            good[live[joined]] = False
            x_made, y_made = self.made[x], self.made[y]
            go = ~joined & ((x_made >= 0) | (y_made >= 0))
            live, x, y, x_until, y_until, x_made, y_made = (v[go] for v in (live, x, y, x_until, y_until, x_made, y_made))
            # The later of the two is undone: of equal ranks y, whose merge stands further right.
            undo_x = x_made > y_made
            x_until, y_until = np.where(undo_x, x_made, x_until), np.where(undo_x, y_until, y_made)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def proposed(self, data: bytes) -> list[int]:
        """Tokens by greedy longest match."""
        get, lengths, single, out, at, end = self.tokens.get, self.lengths.get, self.single, [], 0, len(data)
        while at < end:
            for size in lengths(data[at : at + 2], ()):
                found = get(data[at : at + size]) if at + size <= end else None
                if found is not None:
                    out.append(found)
                    at += size
                    break
            else:
                out.append(single[data[at]])
                at += 1
        return out

    def merged(self, data: bytes) -> list[int]:
        """Exact encoding: of all adjacent pairs the one of lowest rank, leftmost first, until none merges."""
        ids, n = [self.single[b] for b in data], len(data)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        find = self.merges.get
        heap = [(found[0], i, ids[i], ids[i + 1], found[1]) for i in range(n - 1) if (found := find((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = whole, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := find((whole, ids[after[i]])):
                    heapq.heappush(heap, (found[0], i, whole, ids[after[i]], found[1]))
            if before[i] >= 0 and (found := find((ids[before[i]], whole))):
                heapq.heappush(heap, (found[0], before[i], ids[before[i]], whole, found[1]))
        return [i for i in ids if i >= 0]

    def learn(self, units: list[str]) -> dict[str, bytes]:
        """The ids of units, as bytes: proposals of all, all seams tested at once, exact merging where one fails."""
        data = [u.encode() for u in units]
        tokens = [self.proposed(d) for d in data]
        size = np.array([len(t) for t in tokens], np.int64)
        flat = np.array([i for t in tokens for i in t], np.int64)
        unit = np.repeat(np.arange(len(units)), size)
        inside = np.flatnonzero(unit[1:] == unit[:-1])
        wrong = unit[inside[~self.compatible(flat[inside], flat[inside + 1])]]
        self.failed = np.unique(wrong)
        for u in self.failed.tolist():
            tokens[u] = self.merged(data[u])
        return {u: np.array(t, "<u4").tobytes() for u, t in zip(units, tokens, strict=True)}

    def parts(self, text: str) -> list[str]:
        """The text's units and special strings."""
        if not self.cut or not any(s in text for s in self.special):
            return self.units(text)
        return [u for k, part in enumerate(self.cut.split(text)) for u in ([part] if k % 2 else self.units(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each, the lowest first."""
        parts = [self.parts(t) for t in texts]
        if len(self.kept) >= MOST_UNITS:  # units not met again since the last turn go
            self.older, self.kept = self.kept, {}
        new = set().union(*parts) - self.kept.keys()
        self.kept |= {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        again = {u: self.older[u] for u in new & self.older.keys()}
        found = again | self.learn(sorted(new - again.keys() - self.special.keys()))
        self.kept |= {u: x for u, x in found.items() if len(u) <= MOST_KEPT}
        long = {u: x for u, x in found.items() if len(u) > MOST_KEPT}
        get = (self.kept | long if len(long) > 1000 else self.kept).__getitem__
        return [b"".join(map(get, p)) if not long else b"".join([long[u] if u in long else get(u) for u in p]) for p in parts]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def bpe_round_trip(docs: DataFrame, vocabulary: str, keep_ids: bool = False, keep_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit numbers), decoded_sha256 (of the
    decoded text in UTF-8). keep_ids adds ids (binary), keep_text decoded (string). vocabulary is a path that each
    executor can read."""
    slim_batches(docs.sparkSession)
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.binary())] * keep_ids + [("decoded", pa.string())] * keep_text

    def coded(parts):
        pairs = per_worker(f"pairs {vocabulary}", lambda: BytePairs(vocabulary))
        for batch in parts:
            ids = pairs.encode([t.as_py() or "" for t in batch.column(1)])
            texts = [pairs.decode(x) for x in ids]
            columns = [batch.column(0), [len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(t.encode()).hexdigest() for t in texts]] + [ids] * keep_ids + [texts] * keep_text
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], schema=pa.schema(kinds))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids + ", decoded string" * keep_text
    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(coded, schema)
