"""Null ids, repeated rows, columns of clashing names and types, texts of many MB, and empty tables, in every operator."""

import pytest

from chronoloom.llm import bpe, decontamination, license_scan, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, spelling_variants, substring_dedup, token_counts

P = pytest.importorskip("public_tokenizers")

TEXT = "the quick brown fox jumps over the lazy dog and then walks home again " * 3
SCHEMA = "doc_id long, text string, n_words string, hash array<int>, place double, __line_gone int, __quality_x int, row string, c int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None, TEXT), (None, TEXT), (None, None), (None, ""), (7, TEXT), (7, TEXT), (7, "other words in this row of the same id"), (8, None), (9, "x " * 200_000), (10, "word" * 300_000), (11, "\n" * 50_000)]
    return spark.createDataFrame([(*r, "a", [1], 0.5, 1, 2, "r", 3) for r in rows], SCHEMA).repartition(2)


@pytest.fixture(scope="module")
def others(spark):
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, None), (None, 1), (99, 1)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, TEXT), (None, "other words in this row of the same id"), (3, None), (3, "")], "item_id long, text string")
    return labels, items


def operators(labels, items):
    piece, byte = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
    return {
        "rules": quality_rules.quality_rules,
        "passing": quality_rules.passing,
        "lines": line_dedup.line_dedup,
        "deduplicated": line_dedup.deduplicated,
        "tokens": lambda d: token_counts.token_counts(d, piece),
        "quality": lambda d: quality_classifier.quality_scores(d, labels),
        "no labels": lambda d: quality_classifier.quality_scores(d, labels.filter("false")),
        "license": license_scan.license_scan,
        "lm": lm_scoring.lm_scores,
        "packing": lambda d: packing.pack(d, byte),
        "substrings": substring_dedup.substring_dedup,
        "leaks": lambda d: decontamination.contaminated(d, items),
        "clean": lambda d: decontamination.clean(d, items),
        "near": near_dedup.near_duplicates,
        "spelling": spelling_variants.spelling_variants,
        "round trip": lambda d: bpe.bpe_round_trip(d, byte),
    }


@pytest.mark.parametrize("name", sorted(operators(None, None)))
def test_hard_rows(docs, others, name):
    run = operators(*others)[name]
    got = run(docs).collect()
    if name == "passing":
        assert len(got) <= 11
    elif name == "clean":  # rows that hold an item go
        assert len(got) == 6
    elif name == "leaks":
        assert len(got) == 5
    elif name == "spelling":  # "another" and others of seven letters are rare; the long run occurs once
        assert all(r["n"] >= 2 and len(r["word"]) >= 7 for r in got)
    elif name == "packing":
        assert len({(r["doc_id"], r["doc_tokens"]) for r in got}) >= 6
    else:
        assert len(got) == 11
    assert run(docs.filter("false")).count() == 0


def test_pipeline_stages_on_hard_rows(spark, docs, others, tmp_path):
    import corpus_pipeline

    others[1].write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        left[name] = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
        assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0
    # Without an id a row stays in near-dedup; rows of one id go or stay by their own text.
    assert len(left["near dedup"]) == 11
    # The rows without an id come last and lose the line that row 7 has; what has no word left goes.
    assert all(t != TEXT for i, t in left["line dedup"] if i is None) and sum(t == TEXT for i, t in left["line dedup"]) == 2
    assert len(left["decontamination"]) == 6
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()} == {None, 7, 8, 9, 10, 11}
