"""The corpus operators against brute force on small hard cases."""

import hashlib
import math

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from chronoloom.llm import decontamination, license_scan, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, substring_dedup, tables, token_counts

SCHEMA = "doc_id long, text string, n_words int, kept string, score string"
WORDS = [f"{a}{b}" for a in ("al", "be", "co", "du", "en", "for", "gri", "hu") for b in ("na", "rt", "mi", "po", "st", "ve")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def corpus(seed=1):
    """Plain, copied, nearly copied, long, odd, empty and null texts; columns that clash with results."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(25, 120)) for _ in range(25)]
    base = prose(rng, 110).split(" ")
    for _ in range(25):  # a group of near copies, some beyond the threshold
        copy = list(base)
        for _ in range(rng.randint(0, 7)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        texts.append(" ".join(copy))
    shared = prose(rng, 60)
    texts += [texts[0], texts[1], texts[1], texts[2].upper(), shared, prose(rng, 30) + " " + shared, shared + "\n" + prose(rng, 20)]
    texts += ["", " \t\n ", None, "one", "One two three", "the the the the the the the the the the the the the the the the the the the the the the", "a\n" * 40, "éü 日本 語 　x", "x" * 3000, "### $$$ &&& " * 20]
    texts += [prose(rng, 6000), "Released under the MIT License.\nfoo", "Licensed under the Apache License, Version 2.0.", "GNU general public license this work is licensed under version 3", "cc by nc cc by nc"]
    return [(i * 3 + 5, t, 1, "x", "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_quality_rules(docs, nothing):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    for i, t, *_ in corpus():
        w = split(t)
        lines = [x for x in (t or "").split("\n") if split(x)]
        grams = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        hit = set()
        for j in range(len(w) - 7):
            if grams[tuple(w[j : j + 8])] > 1:
                hit.update(range(j, j + 8))
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 20 or 100 * len(hit) > 30 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.quality_rules(nothing).count() == 0
    kept = quality_rules.passing(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def union(n):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    return up, top


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    up, top = union(1100)
    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = {r["id"]: r["component"] for r in tables.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == top(x) for x in range(1100))
    assert tables.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("small", [near_dedup.SMALL, 4])
def test_near_duplicates(docs, nothing, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "LEAF", 4 * small)
    monkeypatch.setattr(near_dedup, "BLOCK", 4 * small)
    rows = corpus()
    sets = []
    for _, t, *_ in rows:
        w = split(lowered(t))
        sets.append({tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    up, top = union(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs, k=4).collect()}
    for n, (i, *_) in enumerate(rows):
        assert got[i]["n_shingles"] == len(sets[n])
        assert got[i]["component_id"] == rows[top(n)][0]
        assert got[i]["kept"] == (top(n) == n)
    if small == 4:
        assert near_dedup.near_duplicates(nothing).count() == 0


def test_near_copies_around_the_threshold(spark, monkeypatch):
    """A crowd of versions of one text, most pairs at similarities of 0.6 to 0.9: groups as by brute force. Nodes branch
    on to the last level and are compared in blocks."""
    for name, value in (("SMALL", 6), ("LEAF", 12), ("BLOCK", 16)):
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(9)
    base, rows = prose(rng, 140).split(" "), []
    for i in range(220):
        copy = list(base)
        for _ in range(rng.randint(2, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS) + rng.choice(WORDS)
        rows.append((i, " ".join(copy)))
    sets = [{tuple(w[j : j + 4]) for j in range(len(w) - 3)} for w in (t.lower().split() for _, t in rows)]
    up, top = union(len(rows))
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for i, j in pairs:
        a, b = sorted((top(i), top(j)))
        up[b] = a
    groups = len({top(i) for i in range(len(rows))})
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), k=4).collect()}
    same = sum(got[i] == got[j] for i, j in pairs)
    print("links", len(pairs), "kept", same, "groups", groups, len(set(got.values())))
    assert 1 < groups < 200 and same >= 0.99 * len(pairs)
    assert all(top(i) == top(got[i]) for i in got)


def test_line_dedup(docs, nothing):
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    seen = set()
    for i, t, *_ in corpus():
        for line in (t or "").split("\n"):
            assert got[i]["n_lines"] == (0 if t is None else len(t.split("\n")))
            form = " ".join(re.findall(r"[^\W_]+", re.sub(r"\d+", "0", line.lower())))
            if len(form.split(" ")) >= line_dedup.MIN_WORDS:
                kept = line in (got[i]["text"] or "").split("\n")
                assert kept or form in seen or got[i]["n_removed"]
                seen.add(form)
    copies = [i for i, t, *_ in corpus() if t == corpus()[1][1]]
    assert [got[i]["n_removed"] > 0 for i in copies] == [False, True, True]
    out = line_dedup.deduplicated(docs.withColumn("__line_x", docs["n_words"]).drop("kept").withColumn("hash", docs["score"]))
    assert out.columns == ["doc_id", "text", "n_words", "score", "__line_x", "hash", line_dedup.P + "counts"]
    out = line_dedup.deduplicated(docs)
    assert out.columns == [*docs.columns, line_dedup.P + "counts"]
    assert line_dedup.line_dedup(nothing).count() == 0


def test_similar_lines_are_one_group(spark):
    line = " ".join(WORDS[:40])
    near = [line, line.upper() + "!", line.replace(WORDS[3], WORDS[3] + "s"), "7 " + line, "8 " + line, " ".join(reversed(WORDS[:40]))]
    rows = [(i, "\n".join([x, "own line number of this document is " + "abcdefgh"[i] * 12])) for i, x in enumerate(near)]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == 0 and got[1] == 1 and got[4] == 1 and got[5] == 0


def test_substring_dedup(docs, nothing):
    seen, want = set(), {}
    for i, t, *_ in sorted(corpus(), key=lambda r: r[0]):
        w = split(t)
        gone = set()
        for j in range(len(w) - 19):
            g = tuple(w[j : j + 20])
            if g in seen:
                gone.update(range(j, j + 20))
            seen.add(g)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substring_dedup.substring_dedup(docs, keep_text=True).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    assert all(sum(s["words"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_substring_dedup_of_repeated_ids(spark):
    rng = random.Random(8)
    passage, other = prose(rng, 30), prose(rng, 25)
    rows = [(1, passage), (1, passage), (1, other + " " + passage), (2, passage), (3, None), (None, other)]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 25), (1, 0), (1, 0), (1, 30), (2, 30), (3, 0)]


def test_decontamination(spark, docs, nothing):
    rng = random.Random(3)
    rows = corpus()
    long = split(rows[-5][1])
    items = [(1, " ".join(long[100:140])), (2, " ".join(long[200:230] + ["zz"] * 2)), (3, prose(rng, 30)), (4, "One two three"), (5, ""), (6, None), (7, " ".join(long[100:140])), (8, rows[0][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shared"]) for r in decontamination.contaminated(docs, table).collect()}
    want = set()
    for i, t, *_ in rows:
        w = split(lowered(t))
        for n, q in items:
            q = split(lowered(q))
            k = min(5, len(q))
            own = {tuple(q[j : j + k]) for j in range(len(q) - k + 1)} if k else set()
            shared = len(own & {tuple(w[j : j + k]) for j in range(len(w) - k + 1)})
            if own and 100 * shared >= 80 * len(own):
                want.add((i, n, shared))
    assert got == want and want
    left = decontamination.clean(docs, table)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {r[0] for r in rows} - {x[0] for x in want}
    assert decontamination.contaminated(nothing, table).count() == 0
    assert decontamination.contaminated(docs, table.filter("false")).count() == 0


LISTED = [(x, license_scan.words_of(m).split()) for table in (license_scan.TEMPLATES, license_scan.TEXTS) for x, m in table.items()]


def holds_in_order(w, m, reach):
    """Whether a stretch of at most reach words has the words of m in their order."""
    for j in (j for j, x in enumerate(w) if x == m[0]):
        k = 0
        for x in w[j : j + reach]:
            k += x == m[k]
            if k == len(m):
                return True
    return False


def license_blocks(w):
    """Labels of the templates that some window meets, by definition."""
    sets, met = [set(m) for _, m in LISTED], set()
    for i, (_, m) in enumerate(LISTED):
        reach = max(len(m) * 125 // 100, len(m) + license_scan.BETWEEN)
        if len(m) < license_scan.SHORT:
            met |= {i} if holds_in_order(w, m, reach) else set()
            continue
        like = [u for y, u in enumerate(sets) if y != i and 100 * len(sets[i] & u) >= 80 * len(sets[i])]
        if 100 * len(sets[i] & set(w)) < 80 * len(sets[i]):
            continue
        for j in range(len(w)):
            b = set(w[j : j + reach])
            if 100 * len(sets[i] & b) >= 80 * len(sets[i]) and all(sets[i] - u <= b for u in like):
                met.add(i)
                break
    return {LISTED[i][0] for i in met if not any(sets[i] < sets[y] for y in met)}


NOTICES = [
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
    ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.", "agpl-3"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("This work is licensed under a Creative Commons\nAttribution 4.0 International License", "cc-by"),
    ("It was released under the GPL license", ""),
    ("released " + "and so on " * 60 + "under the " + "next day " * 60 + "mit license", ""),
    ("copyright 2020, all rights reserved. " + "word " * 30 + "COPYRIGHT: all\nrights reserved", "all-rights-reserved"),
    ("Copyright 2020 Foo. All rights reserved.", "all-rights-reserved"),
    ("Copyright (c) 1998-2004 The Foo and Bar Company. All rights reserved.", "all-rights-reserved"),
    ("he reserved all rights to copyright", ""),
    ("copyright " + "and then some " * 5 + "all rights reserved", ""),
    ("All rights reserved by copyright", ""),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.", "apache-2"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl-2"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "cc-by-nd"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Permission was granted to the farmers to use the road without restriction, free of charge, and any person could obtain a copy of the map.", ""),
    ("The software is provided as is, said the seller, without a warranty of any kind.", ""),
    ("Anyone is free to copy the poem.", ""),
    ("You may obtain a copy of the license plate at the office.", ""),
    ("The committee licensed the work under the terms of a creative agreement on attribution.", ""),
    ("Redistribution of income is permitted with modification of the tax in source countries.", ""),
    ("This program is free for members; you can modify your plan at any later time.", ""),
    ("", ""),
    *[(f"Copyright (c) {1990 + 3 * i} Holder of Texts and Sons\n\n{text}\n\nint main() {{ return {i}; }}", label) for i, (label, text) in enumerate(license_scan.TEXTS.items())],
    *[("# " + text.replace("\n", "\n# ").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS OF THE UNIVERSITY AND CONTRIBUTORS"), label) for label, text in license_scan.TEXTS.items()],
    (" ".join(license_scan.TEXTS["zlib"].split()[:14]), ""), (" ".join(license_scan.TEXTS["boost"].split()[:30]), ""), (" ".join(license_scan.TEXTS["bsd-2"].split()[:16]), "bsd"),
    *[(text.upper(), label) for label, text in license_scan.TEXTS.items()],
]


def test_license_blocks(spark):
    rng = random.Random(10)
    rows = [(i, t) for i, (t, _) in enumerate(NOTICES)]
    assert len(NOTICES) >= 50
    for _, m in LISTED:  # templates with words left out or put between, near the bound
        for n in range(6):
            w = list(m)
            for _ in range(rng.randint(0, len(w) // 3)):
                w[rng.randrange(len(w)) : rng.randrange(len(w)) + 1] = rng.choice([[], ["zz"], ["yy", rng.choice(w)]])
                w = w or ["zz"]
            rows.append((1000 + len(rows), prose(rng, 20) + " " + " ".join(w)))
    got = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
        assert {b["label"] for b in got[i]["blocks"]} == license_blocks(w), t
        for b in got[i]["blocks"]:
            held = set(w[b["first"] : b["first"] + b["words"]])
            assert b["share"] in [len(set(m) & held) / len(set(m)) for x, m in LISTED if x == b["label"]]
    assert [(t[:60], got[i]["labels"]) for i, (t, _) in enumerate(NOTICES)] == [(t[:60], x) for t, x in NOTICES]


def test_license_scan(docs, nothing):
    got = {r["doc_id"]: r for r in license_scan.license_scan(docs).collect()}
    for i, t, *_ in corpus():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
        at, base, met = [], set(), set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            for j in range(len(w) - len(p) + 1):
                if w[j : j + len(p)] == p:
                    at.append(j)
                    base.add(label)
        met = license_blocks(w)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(base)), ",".join(sorted(base | met)))
    assert license_scan.license_scan(nothing).count() == 0


P = pytest.importorskip("public_tokenizers")


def test_token_counts(docs, nothing):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, P.path("piece_bpe_32k.model"), budget=50, keep_tables=True).collect()}
    rng = random.Random(4)
    for i, t, *_ in corpus():
        t, r = t or "", got[i]
        assert (r["n_bytes"], r["n_tokens"]) == (len(t.encode()), len(sp.encode(t)))
        assert r["over_limit"] == (r["n_tokens"] > 50)
        for k in [*rng.sample(range(len(t) + 1), min(6, len(t))), len(t)]:
            assert token_counts.tokens_at(r["prefix_counts"], k) == len(sp.encode(t[:k]))
        if t:
            fit = r["fit_chars"]
            assert len(sp.encode(t[:fit])) <= 50 and (fit == len(t) or len(sp.encode(t[: fit + 1])) > 50)
    assert token_counts.token_counts(nothing, P.path("piece_bpe_32k.model")).count() == 0


def test_packing(docs, nothing):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), keep_ids=True).collect()
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, t, *_ in corpus():
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == ids
        at = 0
        for r in pieces:
            own = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r["length"]
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack(nothing, P.path("byte_bpe_50k.json")).count() == 0


def test_cuts_cost_least():
    rng = random.Random(5)
    for _ in range(150):
        limit = rng.choice([8, 16, 20])
        place = [0]
        for _ in range(rng.randint(1, 20)):
            place.append(place[-1] + rng.randint(1, limit))
        pay = np.array([0.0] + [float(rng.choice([0, 3, 9])) for _ in place[1:]])
        least = [0.0] + [math.inf] * (len(place) - 1)
        pad = lambda n: 0 if n & (n - 1) == 0 else limit - n
        for j in range(1, len(place)):
            least[j] = min(least[i] + pad(place[j] - place[i]) + pay[j] for i in range(j) if place[j] - place[i] <= limit)
        cut = packing.cuts(np.array(place), pay, limit)
        assert sum(pad(place[b] - place[a]) + pay[b] for a, b in zip(cut, cut[1:], strict=False)) == least[-1]


def test_lm_scores(docs, nothing):
    got = {r["doc_id"]: r for r in lm_scoring.lm_scores(docs, common=20).collect()}
    token = lambda t: [*split(lowered(t)), "\n"]
    n = Counter()
    for i, t, *_ in corpus():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            n.update(token(t))
    total, known = sum(n.values()), len(n)
    for i, t, *_ in corpus():
        w, r = token(t), got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in n for x in w), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((n[x] + 1) / (total + known + 1)) for x in w))
        assert r["score"] < 0
    assert lm_scoring.lm_scores(nothing).count() == 0


def test_lm_probabilities_add_up(docs):
    model, _, _, top = lm_scoring.trained(docs.select("text"), 10, 100_000)
    p = model.probabilities(top.column(0), *lm_scoring._columns(top, 0)).sum(0) + model.unknown()
    assert np.allclose(p, 1)


def plain_sampler(texts, frequent, endings, known, discounts, sweeps, rng):
    """The same model customer by customer: each leaves and sits down again given all others. Returns averaged
    probabilities of (word, restaurant)."""
    strength = lm_scoring.STRENGTH
    contexts = lm_scoring.Contexts(frequent, endings)
    up = []  # tables of each restaurant and word, as sizes; 0 is the parent
    rooms = [{} for _ in range(contexts.first + endings)]
    d = lambda r: discounts[min(r, 1)]
    total = lambda r: sum(sum(x) for x in rooms[r].values())
    tables = lambda r: sum(len(x) for x in rooms[r].values())
    customers, n_tables = [0] * len(rooms), [0] * len(rooms)

    def p(w, r):
        base = 1 / (known + 1) if r == 0 else p(w, 0)
        own = rooms[r].get(w, [])
        return (sum(own) - d(r) * len(own) + (strength + d(r) * n_tables[r]) * base) / (strength + customers[r])

    def sit(w, r):
        own, base = rooms[r].setdefault(w, []), 1 / (known + 1) if r == 0 else p(w, 0)
        weights = [x - d(r) for x in own] + [(strength + d(r) * n_tables[r]) * base]
        j = rng.choices(range(len(weights)), weights)[0]
        customers[r] += 1
        if j == len(own):
            own.append(1)
            n_tables[r] += 1
            if r:
                sit(w, 0)
        else:
            own[j] += 1

    def leave(w, r):
        own = rooms[r][w]
        j = rng.choices(range(len(own)), own)[0]
        own[j] -= 1
        customers[r] -= 1
        if not own[j]:
            del own[j]
            n_tables[r] -= 1
            if r:
                leave(w, 0)

    seats = [(w, r) for t in texts for words in [lm_scoring.tokens(t)] for w, r in zip(words, contexts.after(words), strict=True)]
    for w, r in seats:
        sit(w, r)
    out, used = Counter(), 0
    for sweep in range(sweeps):
        for w, r in seats:
            leave(w, r)
            sit(w, r)
        if sweep >= sweeps // 4:
            used += 1
            for w in {x for x, _ in seats}:
                for r in range(1, len(rooms)):
                    out[w, r] += p(w, r)
    return {k: v / used for k, v in out.items()}


def test_lm_seating_against_a_plain_sampler(spark):
    import pyarrow as pa

    rng = random.Random(12)
    some = WORDS[:8]
    follow = {w: rng.sample(some, 2) for w in some}
    texts = []
    for _ in range(12):
        w = [rng.choice(some)]
        for _ in range(14):
            w.append(rng.choice(follow[w[-1]] if rng.random() < 0.8 else some))
        texts.append(" ".join(w))
    model, _, ids, top = lm_scoring.trained(spark.createDataFrame([(t,) for t in texts], "text string"), contexts=4, endings=3, sweeps=60)
    found = model.probabilities(top.column(0), *lm_scoring._columns(top, 0))
    want = plain_sampler([pa.scalar(t) for t in texts], [w for w in list(ids)[: ids.own] if w != lm_scoring.END], 3, model.known, model.discounts, 150, rng)
    words = top.column(0).to_pylist()
    error = [abs(math.log(found[i, r] / want[w, r])) for i, w in enumerate(words) for r in range(1, found.shape[1]) if model.customers[r]]
    print("largest and mean difference of log probabilities", max(error), sum(error) / len(error))
    assert sum(error) / len(error) < 0.05 and max(error) < 0.3


def test_lm_beats_unigrams_on_held_out_text(spark):
    rng = random.Random(6)
    follow = {w: rng.sample(WORDS, 3) for w in WORDS}
    rows = []
    for i in range(300):
        w = [rng.choice(WORDS)]
        for _ in range(80):
            w.append(rng.choice(follow[w[-1]]))
        rows.append((i, " ".join(w)))
    got = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    print("scores", sum(r["score"] for r in got) / sum(r["base_score"] for r in got))
    assert got and sum(r["score"] for r in got) > 0.7 * sum(r["base_score"] for r in got)


def test_lm_words_of_one_ending_have_followers_of_their_own(spark, monkeypatch):
    """Scores of pairs below endings from counts of all pairs; words of one ending differ by what follows them, in whatever bucket."""
    monkeypatch.setattr(lm_scoring, "PAIRS", 200)
    rng = random.Random(4)
    before = [f"{a}{b}xy" for a in "abcdef" for b in "ghijkl"]
    follow = {w: [f"{w[:2]}{i}" for i in range(3)] for w in before}
    rows = [(i, " ".join(x for _ in range(10) for w in [rng.choice(before)] for x in (w, rng.choice(follow[w])))) for i in range(150)]
    learnt = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    right = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    wrong = next(i for i in range(right + 1, 2000) if zlib.crc32(str(i).encode()) % 7 == 2)
    texts = [" ".join(f"{w} {follow[before[i - shift]][0]}" for i, w in enumerate(before)) for shift in (0, 1)]
    docs = spark.createDataFrame([*rows, (right, texts[0]), (wrong, texts[1])], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.lm_scores(docs, contexts=2, common=40).collect()}
    assert got[right] > got[wrong] + 20
    model, table, ids, top, cells = lm_scoring.trained(spark.createDataFrame([(t,) for t in learnt], "text string"), contexts=2, own=True)
    seats = Counter()
    for t in learnt:
        words = lm_scoring.tokens(lm_scoring.pa.scalar(t))
        seats.update(zip([lm_scoring.END, *words[:-1]], words, strict=True))
    own, after = Counter(), Counter()
    for (c, _), n in seats.items():
        own[c], after[c] = own[c] + n, after[c] + 1
    assert sum(len(lm_scoring.unpacked(lm_scoring.pa.scalar(bytes(r["c"])), np.uint64)) for r in cells.collect()) == sum(ids[c] >= ids.first for c, _ in seats) and cells.count() > 10
    p = dict(zip(top.column(0).to_pylist(), model.probabilities(top.column(0), *lm_scoring._columns(top, 0)), strict=True))
    d, strength = model.below, lm_scoring.STRENGTH

    def score(t):
        words = lm_scoring.tokens(lm_scoring.pa.scalar(t))
        total = 0
        for c, w in zip([lm_scoring.END, *words[:-1]], words, strict=True):
            q = p[w][ids[c]]
            if ids[c] >= ids.first:
                q = (max(seats[c, w] - d, 0) + (strength + d * after[c]) * q) / (strength + own[c])
            total += math.log10(q)
        return total

    for i, t in [rows[0], rows[1], (right, texts[0]), (wrong, texts[1])]:
        assert got[i] == pytest.approx(score(t), rel=1e-5)


def test_quality_scores(spark, nothing):
    rng = random.Random(7)
    junk = lambda: " ".join(rng.choice(WORDS).upper() + "!!" for _ in range(40))
    rows = [(i, prose(rng, 50) if i % 3 else junk()) for i in range(400)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(400)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_classifier.quality_scores(docs, labels).collect()}
    out = [i for i in range(400) if got[i]["held_out"]]
    assert out == [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["predicted"] == (1 if i % 3 else 0) for i in out) > 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert quality_classifier.quality_scores(nothing, labels.filter("false")).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    spoken = [(i, t and re.sub(r"(\S+ \S+ \S+ )", r"\1the ", t)) for i, t, *_ in corpus()]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in spoken]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(split(rows[4][1])[3:24]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, left = docs, [len(rows)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = tables.stored(stage(spark, now, str(tmp_path)))
        assert now.columns == docs.columns
        left.append(now.count())
    assert left == sorted(left, reverse=True) and left[-1] < left[3]
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in now.select("doc_id").collect()}


def test_lm_words_of_whole_columns_are_those_of_each_text():
    texts = [" A\x0bb\x1cc  ÉD\u0085e f\n", None, "", "\t\r\n", "a a B\x0cb", "x"]
    column = lm_scoring.pa.array(["left out", *texts])[1:]
    word, code, start = lm_scoring.worded(column)
    got = word.take(lm_scoring.pa.array(code)).to_pylist()
    each = [lm_scoring.tokens(t) for t in column]
    assert [got[i:j] for i, j in zip(start, start[1:], strict=False)] == each
    contexts = lm_scoring.Contexts([b"a"], 3)
    assert contexts.before(word, code).tolist() == [c for words in each for c in contexts.after(words)]


def test_only_near_pairs_leave_a_large_leaf(spark):
    """Min-wise values of all agree here, but only the sets of 1 and 2 are near; they meet in two leaves, and leave one."""
    shared = np.arange(1, 101, dtype=np.uint64) << np.uint64(40)
    sets = {1: shared, 2: shared[:90], 3: shared[:60]}
    rows = [(i, s.tobytes(), np.zeros(near_dedup.VALUES, np.uint32).tobytes()) for i, s in sets.items()]
    sets = spark.createDataFrame(rows, "id long, hashes binary, least binary")
    member = spark.createDataFrame([(node, i, i, 1) for node in (7, 8) for i in (1, 2, 3)], "node long, id long, c long, lead_c long")
    assert {tuple(r) for r in near_dedup.alike(member, sets.select("id", "least"), 80).collect()} == {(1, 2), (1, 3), (2, 3)}
    assert [tuple(r) for r in near_dedup.alike(member, sets.select("id", "least"), 80, sets=sets).distinct().collect()] == [(1, 2)]
    rng = np.random.default_rng(3)
    for share, far in ((0.8, False), (0.6, True)):
        every = np.unique(rng.integers(0, 1 << 32, 20_000, dtype=np.uint32))
        x, y = every[: len(every)], every[rng.random(len(every)) < share]
        assert near_dedup.near_enough(x[: near_dedup.SKETCH], y[: near_dedup.SKETCH], 80) != far


def joined_rows(df, key):
    """Rows that inner joins on `key` made, by the metrics of the plan that ran."""
    df.collect()

    def inside(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return inside(node.executedPlan())
        if "QueryStage" in name:
            return inside(node.plan())
        children = node.children()
        own = node.metrics().apply("numOutputRows").value() if "Join" in name and f"{name} [{key}#" in node.simpleString(25) and "Inner" in node.simpleString(25) else 0
        return own + sum(inside(children.apply(i)) for i in range(children.size()))

    return inside(df._jdf.queryExecution().executedPlan())


def test_an_id_meets_its_values_once_for_all_its_leaves(spark):
    """Three ids in forty leaves: each side of the comparison joins three rows with min-wise values and three with sketches."""
    hashes = np.arange(1, 101, dtype=np.uint64) << np.uint64(40)
    rows = [(i, hashes[:n].tobytes(), np.zeros(near_dedup.VALUES, np.uint32).tobytes()) for i, n in ((1, 100), (2, 90), (3, 60))]
    sets = spark.createDataFrame(rows, "id long, hashes binary, least binary")
    member = spark.createDataFrame([(node, i, i, 1) for node in range(40) for i in (1, 2, 3)], "node long, id long, c long, lead_c long")
    for with_sets, steps in ((None, 1), (sets, 2)):
        found = near_dedup.alike(member, sets.select("id", "least"), 80, sets=with_sets)
        assert 0 < joined_rows(found, "id") <= 2 * 3 * steps
