"""A document that holds the whole benchmark: every item is found, however little one item resembles the document."""

import random

from chronoloom.llm import decontamination


def test_document_with_the_whole_benchmark(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    items = [[rng.choice(words) for _ in range(rng.choice((15, 15, 15, 29, 60)))] for _ in range(300)]
    damaged = [x[: -(len(x) - 4) // 5] if i % 2 else x for i, x in enumerate(items)]
    whole, part = " ".join(" ".join(x) for x in items), " ".join(" ".join(x) for x in damaged)
    docs = spark.createDataFrame([(1, whole), (2, part), (3, " ".join(items[0]))], "doc_id long, text string")
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shared"]) for r in decontamination.contaminated(docs, table).collect()}
    grams = lambda w: {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    want = set()
    for d, text in ((1, whole), (2, part), (3, " ".join(items[0]))):
        own = grams(text.split())
        want |= {(d, i, len(grams(x) & own)) for i, x in enumerate(items) if 100 * len(grams(x) & own) >= 80 * len(grams(x))}
    print("found", len(got & want), len(want), [len([x for x in want if x[0] == d]) for d in (1, 2, 3)])
    assert got == want and len(want) > 400


def test_short_items_at_the_threshold(spark):
    """Items of five shingles of which documents hold four."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(9000)]
    items = [[rng.choice(words) for _ in range(9)] for _ in range(1500)]
    docs = [(i, " ".join([*[rng.choice(words) for _ in range(rng.randint(0, 40))], *x[:8], "other"])) for i, x in enumerate(items)]
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), table).filter("doc_id = item_id and n_shared = 4 and n_item = 5")
    assert got.count() == len(items)
