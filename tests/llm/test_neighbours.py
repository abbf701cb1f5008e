import numpy as np

from lakesearch.llm.neighbours import adaptive_scan, nearest_embeddings, neighbours

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, asked, k=5):
    keys = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in asked:
        score = np.round(unit @ unit[keys == q][0], 12)
        score[keys == q] = -9
        out[q] = keys[np.lexsort((keys, -score))[:k]].tolist()
    return out


def answers(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_copies_and_ties(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(200 + i, (2 * np.array(rows[5][1])).tolist()) for i in range(9)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = answers(neighbours(table, table.where("vec_id % 3 = 0")))
    true = exact(rows, [i for i, _ in rows if i % 3 == 0])
    assert found.keys() == true.keys()
    assert sum(len(set(found[q]) & set(true[q])) for q in true) >= 0.9 * 5 * len(true)
    # Among equal and parallel vectors the smallest keys win.
    assert found[3] == [100, 101, 102, 103, 104] and found[102] == [3, 100, 101, 103, 104] and found[201] == [5, 200, 202, 203, 204]


def test_unusable_rows_take_no_part(spark):
    good = [(i, [1.0, float(i), 2.0]) for i in range(3)]
    bad = [(10, None), (11, [0.0, 0.0, 0.0]), (12, [1.0, None, 1.0]), (13, [float("nan"), 1.0, 1.0]), (14, [float("inf"), 1.0, 1.0]), (15, []), (16, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(*r, 0) for r in good + bad + good[:1]], f"{SCHEMA}, rank int")
    found = neighbours(table, table)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert answers(found) == {0: [1, 2], 1: [2, 0], 2: [1, 0]}
    assert neighbours(table.limit(0), table.limit(0)).count() == 0 and neighbours(table, table.limit(0)).count() == 0


def test_scan_never_abandons_with_a_loose_bound():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    rows, found, distance = adaptive_scan(q, x, np.full(20, 1e9), 6)
    true = ((q[:, None] - x) ** 2).sum(2)
    hits = sum(len(set(found[rows == i]) & set(np.argsort(true[i])[:6])) for i in range(20))
    assert hits >= 0.95 * 120 and np.allclose(distance, true[rows, found])


def test_recall_and_scores_on_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = nearest_embeddings(spark, folder).cache()
    true = exact(rows, [i for i, _ in rows if i % 50 == 0])
    got = answers(found)
    assert got.keys() == true.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len(set(got[q]) & set(true[q])) for q in true) >= 0.9 * 5 * len(true)
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    for r in found.limit(100).collect():
        a, b = vectors[r["query_id"]], vectors[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_vectors_of_every_length_are_searched(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(6)] + [(10, [1.0, 0.0, 0.0]), (11, [1.0, 0.1, 0.0]), (12, [2.0] * 4), (13, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours(df, df.where("vec_id in (0, 10, 12, 13)"), k=2).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in found} == {(0, 1, 1), (0, 2, 2), (10, 1, 11)}
