"""The near-copy stage of the corpus pipeline against all pairs."""

import random

import numpy as np

import corpus_pipeline
from catloom.llm import near_copies
from tests.llm import brute
from tests.llm.test_operators import sentence


def test_stage_agrees_with_all_pairs(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, sentence(rng, rng.randint(6, 250))) for i in range(150)]
    for i in range(150):  # copies on both sides of similarity 0.8
        words = rows[i][1].split()
        for _ in range(rng.randint(0, max(1, len(words) // 30))):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        rows.append((1000 - i, " ".join(words)))
    passage = sentence(rng, 30)  # quoted by many, no reason to link
    rows += [(2000 + i, f"{sentence(rng, 40)} {passage}") for i in range(40)]
    rows += [(3000 + i, rows[7][1] + " x" * i) for i in range(6)] + [(4000, "a b"), (4001, "A  b"), (4002, None), (4003, " "), (4004, "a c")]
    df = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string").withColumn("h", near_copies.F.lit("x")).repartition(3)
    gone = brute.later_near_copies(rows)
    assert 80 < len(gone) < 200
    left = corpus_pipeline.near_copies(spark, df, str(tmp_path))
    assert left.columns == df.columns
    assert {r["doc_id"] for r in left.collect()} == {None, *(i for i, _ in rows)} - gone
    assert corpus_pipeline.near_copies(spark, df.limit(0), str(tmp_path)).count() == 0


def test_repeated_ids_and_order(spark):
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(5, text), (5, "another text altogether of a few words"), (3, text + " "), (9, text.upper())], "doc_id long, text string")
    assert {r["doc_id"] for r in near_copies.later_copies(df).collect()} == {5, 9}


def test_radius_covers_similarity_four_fifths():
    rng, missed = np.random.default_rng(3), 0
    for k in range(3000):
        n = int(rng.integers(9, 200))
        common = -(-8 * n // 9)
        pool = rng.integers(0, 1 << 63, 2 * n - common).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        a, b = np.unique(pool[:n]), np.unique(pool[n - common :])
        far = sum((x ^ y).bit_count() for x, y in zip(near_copies.wide_fingerprint(a), near_copies.wide_fingerprint(b)))
        missed += far > near_copies.RADIUS
    assert missed <= 3
