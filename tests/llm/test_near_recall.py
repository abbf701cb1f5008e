import random

import numpy as np

from lakesearch.llm.simhash import fingerprint, one_of_each, shingle_hashes


def similarity(a, b):
    x, y = set(shingle_hashes(a, 5).tolist()), set(shingle_hashes(b, 5).tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


def pairs_near_the_border(seed, n, length=300):
    """Pairs of texts of which some words differ, of similarity 0.8 to 0.86."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        base = [f"word{rng.randrange(5_000)}" for _ in range(length)]
        other = list(base)
        for at in rng.sample(range(length), 6):
            other[at] = f"new{rng.randrange(5_000)}"
        one, two = " ".join(base), " ".join(other)
        if 0.8 <= similarity(one, two) < 0.86:
            out.append((one, two))
    return out


def test_recall_down_to_the_border_against_brute_force(spark):
    pairs = pairs_near_the_border(9, 100)
    rows = [(2 * i + j, text) for i, pair in enumerate(pairs) for j, text in enumerate(pair)]
    kept = {r["doc_id"] for r in one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {2 * i for i in range(100)} <= kept
    assert np.mean([2 * i + 1 not in kept for i in range(100)]) >= 0.9


def test_full_sets_decide_at_the_border(spark):
    rng, rows, expected = random.Random(10), [], 0
    for i in range(60):  # similarity 0.76 to 0.84, which sketches of 128 hashes confuse
        base = [f"word{rng.randrange(5_000)}" for _ in range(400)]
        other = list(base)
        for at in rng.sample(range(400), 9):
            other[at] = f"new{rng.randrange(5_000)}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    kept = {r["doc_id"] for r in one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(60):
        if similarity(rows[2 * i][1], rows[2 * i + 1][1]) < 0.8:
            assert 2 * i + 1 in kept
        elif sum(np.unpackbits(np.array([fingerprint(shingle_hashes(rows[2 * i + j][1], 3)) for j in (0, 1)]).view(np.uint8).reshape(2, 8), axis=1).sum(axis=0) == 1) <= 11:
            expected += 1
            assert 2 * i + 1 not in kept
    assert expected >= 5


def test_unlike_texts_of_one_fingerprint_stay(spark):
    rng = random.Random(11)
    rows = [(i, "same " * 103 + " ".join(f"own{rng.randrange(9_000)}" for _ in range(60))) for i in range(6)]
    rows += [(10 + i, text) for i, text in rows[:2]]
    kept = {r["doc_id"] for r in one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(6))
