import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakesearch.llm.variants import LETTERS, edits, grouped, layouts, spelling_variants, vocabulary, words


def plain_words(rows, damage=199):
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            at = h % len(run)
            run = run[:at] + run[at + 1 :] if h % damage == 0 else run
            if len(run) >= 6:
                yield run


def is_near(a, b):
    """Exactly one edit, by trying each place."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    rows, forms = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if is_near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * n else None
        rows[w] = len(near)
    out = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, rows[w], counts.get(forms[w])))
    return out


def by_operator(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in grouped(df, **options).collect()}


def varied(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("abcé×")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


@pytest.mark.parametrize("limit", [64 << 20, 200])
def test_against_all_pairs_in_one_pass_and_in_many(spark, limit):
    rng = random.Random(1)
    counts = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "é" * 80: 7, "é" * 79: 40, "z" * 3000: 5, "z" * 2999 + "y": 90}
    for _ in range(60):
        word = "".join(rng.choice("abcé") for _ in range(rng.choice([6, 7, 8, 9, 63, 64, 65])))
        for _ in range(4):
            counts.setdefault(word, rng.choice([5, 6, 25, 30, 125, 700]))
            word = varied(rng, word) if len(word) > 6 else word + "b"
    counts = {w: n for w, n in counts.items() if len(w) >= 6}
    assert by_operator(spark, counts, limit=limit) == brute(counts)


def test_passes_cover_every_part_once():
    counts = {6: 1000, 7: 10, 64: 5000}
    for limit in (8, 100, 1600, 1 << 20):
        seen = [(size, part) for p in layouts(counts, limit) for size, (_, _, parts) in p.items() for part in parts]
        assert len(seen) == len(set(seen))
        for size, n in counts.items():
            blocks, parts, _ = next(p[size] for p in layouts(counts, limit) if size in p)
            assert len([x for x in seen if x[0] == size]) == parts and blocks * parts * 2 >= n and 8 * blocks <= max(8, limit)


def test_edits_hash_like_the_words_they_make():
    from lakesearch.llm.variants import cell_hashes

    word = np.frombuffer(b"bookkeeper", np.uint8)[None]
    hashed = lambda w: int(np.bitwise_xor.reduce(cell_hashes(w[None]), axis=1)[0])
    for _, at, hashes, valid, size in edits(word, LETTERS[:26], 6):
        for place in zip(*np.nonzero(valid)):
            i = place[1] + at
            new = np.delete(word[0], i) if len(place) == 2 else np.concatenate([word[0][:i], LETTERS[place[2] : place[2] + 1], word[0][i + 1 :]])
            assert len(new) == size and int(hashes[place]) == hashed(new)


def test_words_and_counts_against_plain_python(spark):
    rng = random.Random(2)
    pool = ["Banana", "banana", "bananá", "Éclairs", "éclairs", "short", "naïveté", "well-known", "o×o÷oo", "abcdef9ghijkl", "x" * 50_000]
    rows = [(k if k % 7 else None, " ".join(rng.choice(pool) for _ in range(rng.randrange(30))) if k % 5 else None) for k in range(300)]
    rows += [(3, ""), (3, "Banana"), (3, "Banana")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for damage in (199, 3):
        found = {r["word"]: r["n"] for r in vocabulary(words(df, "doc_id", "text", damage=damage), 1).collect()}
        assert found == dict(Counter(plain_words(rows, damage)))


def test_empty_tables(spark):
    assert by_operator(spark, {}) == set()
    assert by_operator(spark, {"lonely": 9}) == {("lonely", None, "lonely", 9, 0, None)}
    assert grouped(vocabulary(words(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), "doc_id", "text"))).count() == 0


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: n for w, n in Counter(plain_words(rows)).items() if n >= 5}
    found = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling_variants(spark, folder).collect()}
    assert found == brute(counts)
