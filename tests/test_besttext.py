import random

import pytest
from pyspark.sql import functions as F

from lakesearch.operators.besttext import best_documents
from lakesearch.operators.fulltext import text_search


def tables(spark, seed, documents=400, queries=12):
    """Random parts and query terms; many parts are equal, so that scores tie."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    parts = [(d if d else None, f, t, rng.choice([0.0, 0.5, 1.0, rng.random()])) for d in range(documents) for f in ("title", "body") for t in rng.sample(words, rng.randrange(8))]
    terms = [(q if q else None, t, rng.choice([0.0, 1.0, 2.5])) for q in range(queries) for t in rng.sample([*words, "unknown"], rng.randrange(1, 6))]
    return parts, terms


def brute(parts, terms, k, widest):
    scores = {}
    for q, t, w in terms:
        for d, f, u, p in parts:
            if t == u:
                fields = scores.setdefault(q, {}).setdefault(d, {})
                fields[f] = fields.get(f, 0.0) + p * w
    best = {}
    for q, found in scores.items():
        ranked = sorted(((round(max(x.values()) if widest else sum(x.values()), 9), d) for d, x in found.items()), key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
        best[q] = [s for s, _ in ranked[:k]], ranked
    return best


@pytest.mark.parametrize("widest", [False, True])
@pytest.mark.parametrize("k", [1, 7, 2000])
def test_against_brute_force(spark, k, widest):
    parts, terms = tables(spark, k)
    df = spark.createDataFrame(parts, "key long, field string, term string, _part double").repartition(5)
    asked = spark.createDataFrame(terms, "q long, term string, weight double")
    true = brute(parts, terms, k, widest)
    for options in ({}, {"block": 50}, {"limit": 400, "block": 1}):
        rows = best_documents(df, asked, ["title", "body"], "q", "key", k, "s", widest, **options).collect()
        found = {}
        for r in rows:
            found.setdefault(r["q"], []).append((r["s"], r["key"]))
        assert found.keys() == true.keys()
        for q, (scores, everything) in true.items():
            mine = sorted(found[q], key=lambda r: -r[0])
            assert [s for s, _ in mine[:k]] == pytest.approx(scores)
            assert {(d, round(s, 6)) for s, d in mine} <= {(d, round(s, 6)) for s, d in everything}


def test_ties_fall_back_to_the_key(spark):
    parts = [(d, "f", "t", 1.0) for d in range(500)]
    df = spark.createDataFrame(parts, "key long, field string, term string, _part double").repartition(1)
    asked = spark.createDataFrame([(1, "t", 1.0)], "q long, term string, weight double")
    assert sorted(r["key"] for r in best_documents(df, asked, ["f"], "q", "key", 5, "s", block=20).collect()) == [0, 1, 2, 3, 4]


def test_nothing_asked_and_nothing_stored(spark):
    df = spark.createDataFrame([(1, "f", "t", 1.0)], "key long, field string, term string, _part double")
    asked = spark.createDataFrame([(1, "t", 1.0)], "q long, term string, weight double")
    assert best_documents(df, asked.where("false"), ["f"], "q", "key", 5, "s").count() == 0
    assert best_documents(df.where("false"), asked, ["f"], "q", "key", 5, "s").count() == 0


@pytest.mark.parametrize("scorer", ["BM25STD", "TFIDF", "DISMAX"])
def test_the_best_of_a_batch_are_those_of_all_matches(spark, scorer):
    rng = random.Random(8)
    words = ["sun", "moon", "star", "sky", "cloud", "rain", "wind", "snow"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(12))), " ".join(rng.choice(words) for _ in range(3))) for i in range(2500)]
    df = spark.createDataFrame(rows, "_key long, body string, title string").repartition(6)
    queries = spark.createDataFrame([(i, " ".join(rng.sample(words, 3))) for i in range(6)] + [(9, "nothing")], "query_id long, text string")
    options = dict(fields={"body": 1.0, "title": 3.0}, scorer=scorer, queries=queries, return_fields=[])
    for k in (3, 2000):
        every = text_search(df, k=None, **options).collect()
        found = text_search(df, k=k, **options)
        got = {}
        for r in found.collect():
            got.setdefault(r["query_id"], set()).add((r["_key"], r["score"]))
        for q in {r["query_id"] for r in every}:
            ranked = sorted(((r["_key"], r["score"]) for r in every if r["query_id"] == q), key=lambda r: (-r[1], r[0]))
            assert got[q] == set(ranked[:k])
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1
    assert text_search(df, k=3, **options).where(F.col("query_id") == 9).count() == 0
