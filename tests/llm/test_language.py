from lakesearch.llm.language import identify, language_stage, train
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN, DE = "the cat and the dog are in the house", "der hund und die katze sind in dem haus"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows], SCHEMA)


def test_known_words_and_backoff(spark):
    model = train(docs(spark, [(i, t, x) for i in range(20) for t, x in ((EN, "en"), (DE, "de"))]))
    texts = [(0, EN), (1, DE), (2, "hundhaus katzen"), (3, "thehouse"), (4, None), (5, ""), (6, "123 ... ½"), (7, EN * 3000)]
    found = identify(spark.createDataFrame(texts, "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in found] == ["en", "de", "de", "en", "und", "und", "und", "en"]
    assert all(0 <= r["score"] <= 1 for r in found) and found[0]["score"] > 0.9 and found[4]["score"] == 0


def test_no_labels_knows_nothing(spark):
    model = train(docs(spark, [(1, EN, None), (2, None, "en")]))
    assert [tuple(r) for r in identify(docs(spark, [(1, EN, None)]).select("text"), model).collect()] == [(EN, "und", 0.0)]
    assert train(docs(spark, [])).languages == []


def test_clashing_columns_are_replaced_and_rows_repeat(spark):
    model = train(docs(spark, [(i, t, x) for i in range(5) for t, x in ((EN, "en"), (DE, "de"))]))
    rows = spark.createDataFrame([(1, EN, "x", 9.0), (1, EN, "x", 9.0)], "doc_id long, text string, LANG_PRED string, score double")
    found = identify(rows, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"] and [r["lang_pred"] for r in found.collect()] == ["en", "en"]


def test_tie_takes_the_smaller_language(spark):
    model = train(docs(spark, [(i, EN, x) for i in range(6) for x in ("b", "a")]))
    assert identify(docs(spark, [(1, EN, None)]).select("text"), model).first()["lang_pred"] == "a"


def test_held_out_accuracy(spark):
    from lakesearch.llm.language import predicted_languages

    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = predicted_languages(spark, folder).join(truth, "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_stage_drops_only_what_has_no_language(spark):
    rows = [(i, t, x) for i in range(12) for t, x in ((EN, "en"), (DE, "de"))] + [(100, "1 2 3", "en"), (101, None, None)]
    kept = language_stage(spark, docs(spark, rows), "")
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ") and kept.count() == 24
