import random
import re

import numpy as np
import xxhash

from lakesearch.llm.components import connected
from lakesearch.llm.simhash import allocated, links, near_duplicates, one_of_each, partition_count, resemblance, sketch


def fingerprint(text, words=3):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_query_against_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 60])))) for i in range(60)]
    for i in range(60, 140):
        text = rows[rng.randrange(60)][1].split(" ")
        text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, "  ".join(text).upper() if rng.random() < 0.3 else " ".join(text)))
    rows += [(200, None), (201, ""), (3, rows[3][1]), (None, rows[3][1])]
    found = near_duplicates(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fingerprint int")).collect()
    prints = {(k, t): fingerprint(t) for k, t in rows}
    distinct = sorted(set(prints.values()))
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 3]
    root = components(pairs, distinct)
    first = {}
    for k, t in rows:
        if k is not None:
            first[root[prints[k, t]]] = min(first.get(root[prints[k, t]], k), k)
    expected = sorted(((k, f"{prints[k, t]:016x}", first[root[prints[k, t]]]) for k, t in rows), key=str)
    assert sorted((tuple(r) for r in found), key=str) == expected


def test_links_with_dense_groups_against_all_pairs(spark):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(200)}
    signed = sorted(int(np.uint64(v).astype(np.int64)) for v in values)
    table = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    for bits in (0, 3, 6):
        expected = {(a, b) for i, b in enumerate(signed) for a in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert {tuple(r) for r in links(table, bits).collect()} == expected
    assert links(spark.createDataFrame([], "fp long"), 3).count() == 0


def test_thresholds_are_unequal_and_always_cover():
    costs = [np.array([[0.0, 900, 901, 902, 903]]), np.array([[0.0, 1, 2, 50, 60]]), np.array([[0.0, 1, 30, 50, 60]])]
    assert allocated(costs, 3).tolist() == [[-1, 1, 1]] or int((allocated(costs, 3) + 1).sum()) == 4
    assert partition_count(10, 3) >= partition_count(10**10, 3)


def test_components_of_a_long_chain_and_nulls(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 400), (7, 7), (None, 3)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    base = [f"word{rng.randrange(400)}" for _ in range(200)]
    near = [*base[:100], "changed", *base[101:]]
    other = [f"other{rng.randrange(400)}" for _ in range(200)]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (4, " ".join(other)), (8, None), (7, ""), (None, " ".join(base)), (3, " ".join(near))]
    kept = one_of_each(spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, first int"))
    assert kept.columns == ["doc_id", "text", "first"] and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 7]


def test_resemblance_is_exact_for_small_sets():
    a, b = sketch("a b c d e f g", 5), sketch("a b c d e f h", 5)
    assert resemblance(a, a) == 1.0 and resemblance(a, b) == 0.5 and resemblance(sketch(None, 5), sketch("", 5)) == 1.0
