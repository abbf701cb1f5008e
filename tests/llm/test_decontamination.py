import random

from lakesearch.llm.decontamination import Matcher, contaminated, decontamination_stage, pieces, plain


def search(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_matcher_against_the_full_table():
    rng = random.Random(6)
    for _ in range(800):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(5, 16)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(40)))
        if rng.random() < 0.6:
            text = text[:9] + item[:4] + rng.choice(["", "c", "ab"]) + item[rng.choice([4, 5]) :] + text[9:]
        for budget in range(4):
            found = Matcher([(1, item)], (budget + 0.01) / len(item))(text)
            true = search(item, text)
            assert (1 in found) == (bool(text) and true <= budget) and (1 not in found or found[1][0] == true)


def test_pieces_are_one_more_than_the_budget():
    for budget in range(20):
        leaves = pieces("abcdefghijklmnopqrstuvwxyz", budget)
        assert len(leaves) == budget + 1 and "".join(p.text for p in leaves) == "abcdefghijklmnopqrstuvwxyz"


ITEM = "What is the answer to the ultimate question of life, the universe and everything?"


def test_documents(spark):
    near = ITEM.replace("ultimate", "ulitmate").replace("life", "lives")
    rows = [(1, f"before {ITEM} after"), (2, near.upper()), (3, "nothing of the kind"), (4, None), (5, ""), (None, ITEM), (6, "x " * 60_000 + ITEM.replace(" ", " \n ")), (1, f"before {ITEM} after")]
    docs = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, edits int")
    tests = spark.createDataFrame([(10, ITEM), (11, None), (12, ""), (13, "the"), (14, ITEM)], "item_id long, text string")
    found = sorted((tuple(r)[1:4] for r in contaminated(docs, tests).collect()), key=str)
    expected = [(k, i, e) for k, e in ((1, 0), (1, 0), (6, 0), (None, 0), (2, 5)) for i in (10, 14)]
    assert [f[:2] for f in found] == [e[:2] for e in sorted(expected, key=str)]
    assert all(f[2] == search(plain(ITEM), plain(near)) if f[0] == 2 else f[2] == 0 for f in found)
    assert contaminated(docs, tests.limit(0)).count() == 0 and contaminated(docs.limit(0), tests).count() == 0


def test_stage_keeps_clean_documents(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, ITEM), (2, "clean"), (3, None), (None, "clean")], "doc_id long, text string")
    kept = decontamination_stage(spark, docs, f"file://{tmp_path}").collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(2, "clean"), (3, None), (None, "clean")], key=str)


def test_short_items_are_searched_exactly(spark):
    docs = spark.createDataFrame([(1, "before. An 18 char item! after"), (2, "an 18 char itme"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "an 18 char item!"), (2, ""), (3, None), (4, " ")], "item_id long, text string")
    found = [(r["doc_id"], r["item_id"], r["edits"]) for r in contaminated(docs, items, least_chars=1).collect()]
    assert (1, 1, 0) in found and {i for _, i, _ in found} == {1}
