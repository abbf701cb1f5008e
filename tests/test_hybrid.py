import math

import pytest

from lakesearch.errors import QueryError
from lakesearch.functions.predicates import Num, Tag, Text
from lakesearch.operators.hybrid import Knn, Linear, Range, Rrf, hybrid_search

ONE, FIVE = [1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]


def search(products, schema, text, vector, **options):
    return hybrid_search(products, text, options.pop("field", "description"), vector, "embedding", schema=schema,
                         **{"return_fields": [], **options}).collect()


def test_known_answers(products, product_schema):
    rows = search(products, product_schema, "programming", ONE)
    assert rows[0]["_key"] in ("1", "3") and all(math.isfinite(r["hybrid_score"]) for r in rows)
    # Rank 1 on one side and 2 on the other, by hand; the key breaks the tie.
    assert rows[0]["hybrid_score"] == pytest.approx(1 / 61 + 1 / 62, abs=1e-9)
    linear = search(products, product_schema, "ergonomic", FIVE, combine=Linear(0.5, 0.5), alias="mix")
    assert linear[0]["_key"] == "5" and linear[0]["mix"] == pytest.approx(1.0)
    near = search(products, product_schema, "programming", ONE, method=Range(0.2))
    assert {r["_key"] for r in near} == {"1", "3", "6"}
    some = search(products, product_schema, "zzz", FIVE, vector_where=Tag("category").eq("furniture"))
    assert {r["_key"] for r in some} == {"4", "5"}
    both = search(products, product_schema, "zzz", FIVE, vector_where=Tag("category").eq("furniture") & Num("price").lt(400))
    assert [r["_key"] for r in both] == ["4"]
    cheap = search(products, product_schema, "programming", ONE, post_filter="@price < 200", return_fields=["price"])
    assert cheap and all(r["price"] < 200 for r in cheap)
    assert len(search(products, product_schema, "programming", ONE, k=2)) == 2


def test_output_options(products, product_schema):
    rows = search(products, product_schema, "programming", ONE, return_fields=["brand"], text_score_alias="t", vector_score_alias="v",
                  sort_by=[("brand", "DESC"), "price"], k=3, offset=1)
    assert [r["_key"] for r in rows] == ["4", "5", "2"] and set(rows[0].asDict()) == {"_key", "brand", "t", "v", "hybrid_score"}
    assert rows[0]["t"] is None and rows[0]["v"] == pytest.approx(0.5)
    assert len(search(products, product_schema, "programming", ONE, no_sort=True)) == 6
    assert [r["_key"] for r in search(products, product_schema, "programming", ONE, combine=Rrf(window=1))] in (["3", "1"], ["1", "3"])


def test_text_filter_as_text_side(products, product_schema):
    rows = search(products, product_schema, "ignored", ONE, field=None, text_where=Text("title").eq("desk"), method=Knn(1))
    assert {r["_key"] for r in rows} == {"1", "4", "5"}


def test_a_table_of_queries_equals_single_queries(spark, products, product_schema):
    queries = spark.createDataFrame([(1, "programming", ONE), (2, "ergonomic", FIVE)], "query_id int, text string, vector array<double>")
    many = hybrid_search(products, text_field="description", vector_field="embedding", queries=queries, k=4, return_fields=["brand"],
                         schema=product_schema).collect()
    for i, text, vector in ((1, "programming", ONE), (2, "ergonomic", FIVE)):
        single = search(products, product_schema, text, vector, k=4, return_fields=["brand"])
        assert {(r["_key"], r["brand"], r["hybrid_score"]) for r in many if r["query_id"] == i} == {
            (r["_key"], r["brand"], r["hybrid_score"]) for r in single}


def test_argument_errors(products):
    for bad in (
        dict(text=" "), dict(vector=[]), dict(vector_field=""), dict(k=0), dict(offset=-1), dict(no_sort=True, sort_by=["price"]),
        dict(sort_by=[("price", "UP")]), dict(post_filter=" "), dict(text_score_alias=""), dict(text_field=None),
    ):
        with pytest.raises(QueryError):
            hybrid_search(products, **{"text": "a", "text_field": "title", "vector": ONE, "vector_field": "embedding", **bad})
    for make in (lambda: Knn(0), lambda: Range(-1), lambda: Range(None), lambda: Range(1, -1), lambda: Linear(2, 0), lambda: Linear(0, -1),
                 lambda: Rrf(0), lambda: Rrf(60, 0), lambda: Linear(window=0)):
        with pytest.raises(QueryError):
            make()


def test_the_index_of_a_hybrid_report_holds_no_texts(spark, tmp_path, monkeypatch):
    from lakesearch.plans import hybrids

    spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, [1.0] * 64, 2)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")

    class Built(Exception):
        pass

    def build(df, *args, **options):
        raise Built(df.columns)

    monkeypatch.setattr(hybrids.IvfIndex, "build", build)
    with pytest.raises(Built) as built:
        hybrids._hybrid(ivf=True)(spark, str(tmp_path))
    assert set(built.value.args[0]) == {"doc_id", "lang", "embedding", "label"}
