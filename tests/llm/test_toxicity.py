import random

from pyspark.sql import functions as F

from lakesearch.llm.toxicity import grams, scored, toxic_documents, train


def corpus(rng, n):
    words = [f"{a}{b}" for a in "kulm bor ten sig vad".split() for b in "an er is ot ul".split()]
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 80))
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            text[rng.randrange(len(text))] = rng.choice(["scoundrel", "rascals"])
        yield i, " ".join(text), toxic


def test_learns_and_scores_every_row(spark):
    rng = random.Random(8)
    model = train(spark.createDataFrame(list(corpus(rng, 400)), "doc_id long, text string, toxic int"))
    rows = [(*r, 0.5) for r in corpus(rng, 200)] + [(1000, None, 0, 0.5), (1001, "", 0, 0.5), (1002, " ", 0, 0.5), (1003, "ten " * 60_000, 0, 0.5), (1, "scoundrel", 1, 0.5), (1, "scoundrel", 1, 0.5)]
    found = scored(spark.createDataFrame(rows, "doc_id long, text string, toxic int, Score double"), model)
    assert found.columns == ["doc_id", "text", "toxic", "score", "predicted"] and found.count() == len(rows)
    got = found.where("doc_id < 1000").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert got > 0.97
    empty = {r["score"] for r in found.where("doc_id between 1000 and 1002").collect()}
    assert len(empty) == 1 and 0 < empty.pop() < 0.7


def test_one_class_or_no_labels(spark):
    rows = spark.createDataFrame([(1, "some text", 0), (2, None, 1), (3, "more", None), (4, "odd", 7)], "doc_id long, text string, toxic int")
    assert [round(r["score"], 6) for r in scored(rows, train(rows)).collect()] == [round(1 / 3, 6)] * 4
    assert [r["score"] for r in scored(rows, train(rows.limit(0))).collect()] == [0.5] * 4


def test_grams_are_distinct_and_blank_texts_have_none():
    assert len(grams(None)) == len(grams(" \n")) == 0 and len(grams("aaaa aaaa")) == len(set(grams("aaaa aaaa").tolist()))
    assert grams("A  b").tolist() == grams("a b").tolist()


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = [tuple(r) for r in toxic_documents(spark, folder).where("held_out").join(truth, "doc_id").join(lang, "doc_id").select("score", "predicted", "toxic", "lang").collect()]
    toxic, clean = [r for r in rows if r[2]], [r for r in rows if not r[2]]
    above = sum((a[0] > b[0]) + (a[0] == b[0]) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert above > 0.9 and sum(r[1] for r in clean) < 0.01 * len(clean)
    english = [r[1] for r in toxic if r[3] == "en"]  # few labels of the other languages are toxic
    assert sum(english) > 0.85 * len(english)
