"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from chronoloom.llm import spelling_variants as S


def words_of(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def edits(w, letters):
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    return {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters} - {w}


def brute(words, ratio=10):
    letters = set("".join(words))
    near = {w: sorted((edits(w, letters) & words.keys()) - {w}, key=lambda x: (-words[x], x)) for w in words}
    form = {w: x[0] for w, x in near.items() if x and words[x[0]] >= ratio * words[w]}
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (words[w], len(near[w]), form.get(w), words.get(form.get(w)), root)
    return out


def rows_of(df):
    got = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: tuple(r)[1:] for r in got}


def texts(seed=5):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdéñ") for _ in range(rng.choice([7, 7, 8, 9, 14, 15, 16, 17, 30, 31, 32, 33, 40]))) for _ in range(60)]
    pool = []
    for k, s in enumerate(stems):
        pool += [s] * (200 if k % 3 == 0 else 15)
        for _ in range(6):
            p, c = rng.randrange(len(s)), rng.choice("abcdéñ")
            v = rng.choice([s[:p] + s[p + 1 :], s[:p] + c + s[p:], s[:p] + c + s[p + 1 :]])
            pool += [v] * rng.choice([1, 2, 3, 20])
            pool += [v[:-1]] * rng.choice([0, 2])
    rng.shuffle(pool)
    out = [(k, rng.choice([" ", ", ", "-", "1", "\n"]).join(pool[k * 40 : k * 40 + 40])) for k in range(len(pool) // 40 + 1)]
    return [*out, (None, "Ångström ÅNGSTRÖM ÅNGSTRÖM " * 3), (None, None), (3, ""), (3, "x×÷y" * 4), (8, "repeated repeated Repeated rEpeated"), (8, "repeated"), (9, "ab" * 3000), (10, "ab" * 3000)]


def test_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, 5, "w", 1) for r in rows], "doc_id long, text string, n int, word string, key int").repartition(3)
    want = brute(words_of(rows))
    got = rows_of(S.spelling_variants(docs))
    assert got == want
    assert sum(1 for x in want.values() if x[2]) > 30 and any(x[2] and x[4] != x[2] for x in want.values())


def test_pairs_of_every_length(spark):
    """Lengths on both sides of where the alphabet changes; few letters, so that reduced words meet often."""
    rng = random.Random(2)
    words = {}
    for size in (1, 2, 7, 14, 15, 16, 17, 31, 32, 33, 50):
        for _ in range(25):
            w = "".join(rng.choice("ab") for _ in range(size))
            p = rng.randrange(size)
            for x in (w, w[:p] + w[p + 1 :], w[:p] + "c" + w[p:], w[:p] + "b" + w[p + 1 :]):
                if x:
                    words[x] = rng.randint(2, 50)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = Counter((r["word"], r["near"], r["n"]) for r in S.near_pairs(df).collect())
    want = {(w, x, words[x]) for w in words for x in (edits(w, "abc") & words.keys()) | {w}}
    assert set(got) == want and set(got.values()) == {1}


def test_neighbourhoods_are_full():
    word = "abcabcabd"
    codes = np.array([[ord(c) for c in word]], np.uint32)
    reduced = "".join(chr(int(x)) for x in S.symbol(codes, 8)[0])
    size = {reduced} | edits(reduced, list(map(chr, range(1, 9))))
    row, keys = S.neighbourhood(codes)
    assert len(keys) == len(size) == len(set(keys.tolist())) and set(row.tolist()) == {0}


def test_chains_of_forms(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w5")], "word string, form string")
    assert {tuple(r) for r in S.roots(chain).collect()} == {(f"w{i}", "w13") for i in range(13)} | {("x", "w13")}


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (3, "short words only")]])
def test_nothing(spark, rows):
    out = S.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.count() == 0 and set(out.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
