"""All operators on workers that cannot import this package: functions travel by value, broadcast data is plain."""

import ast
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import public_tokenizers as P
from pyspark.sql import SparkSession
from chronoloom.llm import bpe, decontamination, license_scan, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, quality_rules, spelling_variants, substring_dedup, token_counts, whitening

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")

def here(parts):
    try:
        import chronoloom
    except ModuleNotFoundError:
        return iter([0])
    return iter([1])

assert sum(spark.sparkContext.parallelize([1], 1).mapPartitions(here).collect()) == 0
text = "the quick brown fox jumps over the lazy dog and then walks home again this evening "
docs = spark.createDataFrame([(i, text * (1 + i % 3) + "wordnumber%d" % (i % 4)) for i in range(12)], "doc_id long, text string")
labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
items = spark.createDataFrame([(1, text)], "item_id long, text string")
vectors = spark.createDataFrame([(i, [float(i % 5), float(i % 3), float(i * i % 7)]) for i in range(12)], "vec_id long, embedding array<float>")
piece, byte = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
runs = [
    lambda: quality_rules.quality_rules(docs), lambda: line_dedup.line_dedup(docs), lambda: token_counts.token_counts(docs, piece), lambda: quality_classifier.quality_scores(docs, labels),
    lambda: license_scan.license_scan(docs), lambda: lm_scoring.lm_scores(docs), lambda: packing.pack(docs, byte), lambda: substring_dedup.substring_dedup(docs), lambda: decontamination.contaminated(docs, items),
    lambda: near_dedup.near_duplicates(docs), lambda: spelling_variants.spelling_variants(docs), lambda: whitening.whitening(vectors), lambda: bpe.bpe_round_trip(docs, byte), lambda: decontamination.clean(docs, items),
]
print("rows", [run().count() for run in runs])
"""


def test_all_operators(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    rows = ast.literal_eval(done.stdout.rpartition("rows")[2].strip())
    assert rows[:4] == [12] * 4 and rows[8] == 12 and rows[-1] == 0 and all(rows[:-1])
