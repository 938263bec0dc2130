"""Packing of token streams into sequences of bounded length by order-preserving dynamic programming.

Documents keep the order in which they are read. Their tokens form one stream; a sequence is the stretch between two
cuts, at most `limit` tokens. Cuts may stand at the end of a document (free), after a sentence (penalty SENTENCE), and
in a longer sentence every `limit` tokens (penalty INSIDE). Costs are padding, in tokens, plus penalties; a sequence
whose length is a power of two is not padded.

With p(j) the place of cut j, the least cost up to it is
    best(j) = penalty(j) + min over i, p(j) - p(i) <= limit, of best(i) + limit - (p(j) - p(i)),
a sliding-window minimum of best(i) + p(i), held in a monotone queue, so that each cut is pushed and popped once; for
powers of two the cut at exactly that distance is looked up beside it.

The stream is cut for good at the first document end after BLOCK tokens, so that memory is bounded and every task
works on its own rows without a shuffle. A block's last sequence may be short: one in BLOCK / limit.

Defined results: a null or empty text is a document of the end token alone; very long texts are cut at sentences;
repeated rows are packed each; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoloom.llm.hashing import per_worker, slim_batches

LIMIT, END, BLOCK = 1024, 0, 1 << 19
SENTENCE, INSIDE = 8, 64

#: Characters whose classes are the same in every Unicode version and regex engine; other texts go to the library itself.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ–—‘-”…€]*")
SPECIAL = "<|endoftext|>"


class ByteTokens:
    """The ids of a byte-level byte-pair vocabulary, as `tokenizers` gives them for its JSON file without added special
    tokens. Plain texts are encoded with the same vocabulary and merges by `tiktoken`, several times faster; texts with
    other characters or the special token's string by `tokenizers`."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path) as f:
            model = json.load(f)["model"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
        as_bytes = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        # Ranks follow the merges' order; ids are looked up afterwards.
        rank, self.ids = {}, []
        for token in [bytes([b]) for b in range(256)] + [bytes(byte_of[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]:
            if token not in rank:
                rank[token] = len(rank)
        known = {t: i for i, t in as_bytes.items()}
        self.ids = np.array([known[t] for t in rank], np.uint32)
        self.sentence_end = np.zeros(max(as_bytes) + 2, bool)
        for i, t in as_bytes.items():
            self.sentence_end[i] = t.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=rank, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return self.ids[self.fast.encode_ordinary(text)] if text else self.ids[:0]
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(place: np.ndarray, penalty: np.ndarray, limit: int = LIMIT) -> list[int]:
    """Indices of the cuts of least cost. place: increasing, from 0, no gap over limit; the last is always a cut."""
    n = len(place)
    at, pay = place.tolist(), penalty.tolist()
    best, come = [0.0] * n, [0] * n
    index = {p: i for i, p in enumerate(at)}
    powers = [1 << b for b in range(limit.bit_length()) if 1 << b <= limit]
    queue = deque([0])  # best + place grows from the front
    for j in range(1, n):
        p = at[j]
        while at[queue[0]] < p - limit:
            queue.popleft()
        i = queue[0]
        cost = best[i] + limit - p + at[i]
        for size in powers:
            k = index.get(p - size)
            if k is not None and best[k] < cost:
                i, cost = k, best[k]
        best[j], come[j] = cost + pay[j], i
        value = best[j] + p
        while queue and best[queue[-1]] + at[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(j)
        j = come[j]
    return [0, *reversed(out)]


def packed(documents: list[tuple[int, np.ndarray]], sentence_end: np.ndarray, limit: int = LIMIT):
    """The pieces of one block: (doc_id, start, length, crc32, tokens, sequence, offset), sequences from 0."""
    ids = np.concatenate([x for _, x in documents])
    ends = np.cumsum([len(x) for _, x in documents])
    pay = np.full(len(ids) + 1, -1.0)
    pay[1:][sentence_end[ids]] = SENTENCE
    pay[ends] = 0
    pay[0] = 0
    place = np.flatnonzero(pay >= 0)
    gap = np.diff(place)
    if (gap > limit).any():
        extra = np.concatenate([np.arange(a + limit, b, limit) for a, b in zip(place[:-1][gap > limit], place[1:][gap > limit], strict=True)])
        pay[extra] = INSIDE
        place = np.flatnonzero(pay >= 0)
    cut = place[cuts(place, pay[place], limit)]
    edge = np.unique(np.concatenate([cut, ends]))
    start, end = edge[:-1] if edge[0] == 0 else np.concatenate([[0], edge[:-1]]), edge[1:] if edge[0] == 0 else edge
    doc = np.searchsorted(ends, start, side="right")
    first = ends - np.array([len(x) for _, x in documents])
    sequence = np.searchsorted(cut, start, side="right") - 1
    raw = ids.astype("<u4")
    for a, b, d, s in zip(start.tolist(), end.tolist(), doc.tolist(), sequence.tolist(), strict=True):
        yield documents[d][0], a - int(first[d]), b - a, zlib.crc32(raw[a:b].tobytes()), len(documents[d][1]), s, a - int(cut[s])


def pack(docs: DataFrame, vocabulary: str, limit: int = LIMIT, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start (its document's ids before it), length, ids_crc32 (of its ids as little-endian unsigned
    32-bit numbers), doc_tokens (with the end id), sequence_id, offset (in its sequence). keep_ids adds ids. vocabulary
    is a path that each executor can read. Sequence ids are unique: the task's number and the sequence's place in it."""
    slim_batches(docs.sparkSession)
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())] + [("ids", pa.list_(pa.int32()))] * keep_ids

    def made(parts):
        from pyspark import TaskContext

        tokens = per_worker(f"bytes {vocabulary}", lambda: ByteTokens(vocabulary))
        number, held, size = TaskContext.get().partitionId() << 40, [], 0

        def block():
            nonlocal number, held, size
            rows = list(packed(held, tokens.sentence_end, limit))
            out = list(zip(*rows, strict=True))
            last = out[5][-1] + 1
            out[5] = [number + s for s in out[5]]
            if keep_ids:
                stream, places = np.concatenate([x for _, x in held]), np.cumsum([0, *out[2]])
                out.append([stream[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)])
            number, held, size = number + last, [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(out, kinds, strict=True)], names=[k for k, _ in kinds])

        for batch in parts:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(tokens(text.as_py() or ""), np.uint32(END)).astype(np.uint32)
                held.append((doc_id, ids))
                size += len(ids)
                if size >= BLOCK:
                    yield block()
        if held:
            yield block()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids
    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(made, schema)
