import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakesearch.errors import QueryError
from lakesearch.functions.predicates import Num, Tag, Text
from lakesearch.functions.text import ENGLISH, max_frequency, porter_stem, query_tokens, resolve_stopwords, shingles, stemmed
from lakesearch.operators.fulltext import SCORERS, literal_terms, query_terms, text_query, text_search
from lakesearch.operators.textindex import TextIndex
from lakesearch.schema import DocumentSchema


def found(products, schema, text, **options):
    rows = text_search(products, text, options.pop("fields", "title"), schema=schema, return_fields=[], **options)
    return [r["_key"] for r in rows.collect()]


def test_known_answers(products, product_schema):
    assert found(products, product_schema, "keyboard") == ["3"]
    assert sorted(found(products, product_schema, "desk monitor")) == ["4", "5", "6"]
    assert sorted(found(products, product_schema, "desk", where=Tag("brand").eq("ergo"))) == ["4", "5"]
    assert found(products, product_schema, "computer", where=Num("price").gt(1000)) == ["1"]
    assert found(products, product_schema, "screen", where=Text("title").like("Monitor*")) == ["6"]
    assert found(products, product_schema, "for programming") == ["1"]
    assert found(products, product_schema, "for programming", stopwords=["programming"]) == ["1"]
    assert found(products, product_schema, "for") == []
    assert found(products, product_schema, "for", stopwords=None) == ["1"]
    assert found(products, product_schema, "desk", k=5, offset=1, limit=1) == ["4"]


def test_field_weights_decide_the_order(spark):
    rows = spark.createDataFrame(
        [("a", "solar panel", "nothing here"), ("b", "nothing here", "solar panel")], "_key string, title string, body string"
    )
    for options in (dict(text="solar panel"), dict(queries=spark.createDataFrame([(1, "solar panel")], "query_id int, text string"))):
        for weights, first in (({"title": 10, "body": 1}, "a"), ({"title": 1, "body": 10}, "b")):
            got = text_search(rows, fields=weights, return_fields=[], **options).orderBy(F.desc("score")).collect()
            assert [r["_key"] for r in got][0] == first and len(got) == 2


def test_stopwords():
    assert len(ENGLISH) == 198 and sum("'" not in w for w in ENGLISH) == 153
    assert resolve_stopwords("english") == ENGLISH and resolve_stopwords(None) == frozenset()
    assert resolve_stopwords(["The"]) == {"The"}
    for bad in ("English", "klingon"):
        with pytest.raises(QueryError):
            resolve_stopwords(bad)
    with pytest.raises(QueryError):
        resolve_stopwords(["a", 1])


QUERY = ",Apple, the “Pear” don't wi-fi the. C++ apple ,, é!"


def test_both_query_analysers_agree(spark):
    rows = spark.createDataFrame([(1, QUERY)], "query_id int, text string")
    assert rows.select(query_tokens(F.col("text"))).first()[0] == [
        "apple", "the", "pear", "don't", "wi-fi", "the.", "c++", "apple", "é!"]
    for options in (dict(), dict(stopwords=None), dict(stopwords=["apple"]), dict(term_weights={"Apple": 2.5, "wi-fi": 9.0}), dict(stem=True)):
        query = text_query("text", **options)
        literal = literal_terms(QUERY, query)
        table = {r["term"]: r["weight"] for r in query_terms(rows, "query_id", "text", query).collect()}
        assert table == literal
    plain = literal_terms(QUERY, text_query("text"))
    # Tokens with special characters are neither stopwords nor weighted, and become phrases.
    assert plain == {"apple": 2.0, "pear": 1.0, "don t": 1.0, "wi fi": 1.0, "the": 1.0, "c": 1.0, "é": 1.0}
    assert literal_terms(QUERY, text_query("text", term_weights={"wi-fi": 9.0}))["wi fi"] == 1.0


CORPUS = [
    ("a", "the quick brown fox jumps over the lazy dog", "animals"),
    ("b", "quick quick quick thinking", "speed quick"),
    ("c", "a wi-fi router with wi-fi and fi", "network"),
    ("d", "dog and fox and dog", None),
    ("e", None, "quick dog"),
    ("f", "", ""),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, "_key string, body string, title string")


def by_hand(terms, fields, scorer):
    docs = {k: {"body": b, "title": t} for k, b, t in CORPUS}
    words = {k: {f: None if v is None else [w for w in v.replace("-", " ").split()] for f, v in d.items()} for k, d in docs.items()}
    out = {}
    for f, weight in fields.items():
        lengths = [len(w[f]) for w in words.values() if w[f] is not None]
        mean, total = sum(lengths) / len(lengths), len(docs)
        for term, term_weight in terms.items():
            parts = term.split()
            count = {k: sum(w[f][i : i + len(parts)] == parts for i in range(len(w[f]))) for k, w in words.items() if w[f]}
            n = sum(c > 0 for c in count.values())
            for k, tf in count.items():
                if not tf:
                    continue
                length, peak = len(words[k][f]), max(Counter(words[k][f]).values())
                score = {
                    "BM25STD": math.log(1 + (total - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean)),
                    "BM25": max(math.log((total - n + 0.5) / (n + 0.5)), 0) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean)),
                    "TFIDF": tf * math.log(1 + total / n) / peak,
                    "TFIDF.DOCNORM": tf * math.log(1 + total / n) / length,
                    "DISMAX": tf,
                    "DOCSCORE": 0,
                }[scorer]
                out.setdefault(k, {}).setdefault(f, 0.0)
                out[k][f] += score * weight * term_weight
    if scorer == "DOCSCORE":
        return {k: 1.0 for k in out}
    return {k: (max if scorer == "DISMAX" else sum)(v.values()) for k, v in out.items()}


@pytest.mark.parametrize("scorer", SCORERS)
def test_three_paths_agree_with_a_hand_count(spark, corpus, tmp_path, scorer):
    fields = {"body": 1.0, "title": 2.0}
    weights = {"dog": 0.5}
    want = {k: round(v, 6) for k, v in by_hand({"quick": 1.0, "wi fi": 1.0, "dog": 0.5}, fields, scorer).items()}
    queries = spark.createDataFrame([(1, "quick wi-fi dog")], "query_id int, text string")
    index = TextIndex.build(corpus, ["body", "title"], str(tmp_path / "index"))
    options = dict(fields=fields, scorer=scorer, term_weights=weights, return_fields=[], k=None)
    for got in (
        text_search(corpus, "quick wi-fi dog", **options),
        text_search(corpus, queries=queries, **options),
        text_search(corpus, queries=queries, index=index, **options),
        text_search(corpus, queries=queries, index=TextIndex.open(spark, str(tmp_path / "index")), **options),
    ):
        assert {r["_key"]: round(r["score"], 6) for r in got.collect()} == want


def test_filter_does_not_change_the_statistics(spark, corpus):
    whole = {r["_key"]: r["score"] for r in text_search(corpus, "quick dog", "body", return_fields=[]).collect()}
    for options in (dict(text="quick dog"), dict(queries=spark.createDataFrame([(1, "quick dog")], "query_id int, text string"))):
        some = text_search(corpus, fields="body", where="_key != 'a'", return_fields=[], **options).collect()
        assert {r["_key"]: r["score"] for r in some} == {k: v for k, v in whole.items() if k != "a"}


def test_document_prior_and_zero_weight(corpus):
    prior = corpus.withColumn("rank", F.length("body"))
    got = text_search(prior, "dog", "body", scorer="DOCSCORE", doc_score="rank", return_fields=[]).collect()
    assert [(r["_key"], r["score"]) for r in got] == [("a", 43.0), ("d", 19.0)]
    zero = text_search(corpus, "dog", "body", term_weights={"dog": 0}, return_fields=[]).collect()
    assert [(r["_key"], r["score"]) for r in zero] == [("a", 0.0), ("d", 0.0)]


def test_stemming_and_sound(spark, corpus):
    assert [porter_stem(w) for w in ("caresses", "ponies", "hopping", "relational", "generalization", "sky", "agreed", "falling", "controll")] == [
        "caress", "poni", "hop", "relat", "gener", "sky", "agre", "fall", "control"]
    rows = spark.createDataFrame([(["running", "runs"],), (None,), ([],)], "w array<string>")
    assert [r[0] for r in rows.select(stemmed(F.col("w"))).collect()] == [["run", "run"], None, []]
    assert [r["_key"] for r in text_search(corpus, "jumping thinks", "body", stem=True, return_fields=[]).collect()] == ["b", "a"]
    assert text_search(corpus, "jumping", "body").count() == 0
    queries = spark.createDataFrame([(1, "kwik")], "query_id int, text string")
    sounds = text_search(corpus, queries=spark.createDataFrame([(1, "dawg")], "query_id int, text string"), fields="body", sound=True, return_fields=[])
    assert {r["_key"] for r in sounds.collect()} == {"a", "d"}
    assert text_search(corpus, queries=queries, fields="body", return_fields=[]).count() == 0


def test_token_helpers(spark):
    rows = spark.createDataFrame([(["a", "b", "a", "a"],), ([],), (["x"],)], "w array<string>")
    got = rows.select(shingles(F.col("w"), [1, 3]).alias("s"), max_frequency(F.col("w")).alias("m")).collect()
    assert [r["s"] for r in got] == [["a", "b", "a", "a", "a b a", "b a a"], [], ["x"]]
    assert [r["m"] for r in got] == [3, 0, 1]


def test_one_term_in_every_document_keeps_all_rows(spark):
    """A term that a third of all postings share is broadcast from the query side, so nothing is dropped."""
    rows = spark.range(3000).select(F.col("id").cast("string").alias("_key"), F.concat(F.lit("hot hot cold"), F.col("id") % 3).alias("body"))
    queries = spark.createDataFrame([(1, "hot"), (2, "cold1")], "query_id int, text string")
    got = text_search(rows, queries=queries, fields="body", k=None, return_fields=[]).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {1: 3000, 2: 1000}


def test_large_query_side_joins_by_salted_shuffle(spark, corpus, monkeypatch):
    from lakesearch import runtime

    queries = spark.createDataFrame([(1, "quick wi-fi dog"), (2, "dog")], "query_id int, text string")
    small = set(text_search(corpus, queries=queries, fields="body", return_fields=[]).collect())
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(runtime.broadcast_if_small, "__defaults__", (0,))
    assert set(text_search(corpus, queries=queries, fields="body", return_fields=[]).collect()) == small


def test_argument_errors(corpus):
    for bad in (
        dict(fields=""), dict(fields={}), dict(fields={"body": 0}), dict(fields={"body": float("inf")}), dict(fields=["body"]),
        dict(fields="body", scorer="BM42"), dict(fields="body", term_weights={"two words": 1.0}),
        dict(fields="body", term_weights={"a": -1}), dict(fields="body", stopwords="German"), dict(fields="body", k=0),
    ):
        with pytest.raises(QueryError):
            text_search(corpus, "dog", **bad)
    with pytest.raises(QueryError):
        text_search(corpus, fields="body")


def test_schema_fields_by_alias(spark):
    rows = spark.createDataFrame([("1", "hello world")], "_key string, body string")
    schema = DocumentSchema("s", [{"name": "body", "type": "text"}])
    assert text_search(rows, "world", "body", schema=schema).count() == 1


def _same(index, corpus, text="quick wi-fi dog", **options):
    """The index and the scan find the same with the same scores."""
    queries = corpus.sparkSession.createDataFrame([(1, text)], "query_id int, text string")
    for scorer in ("BM25STD", "TFIDF"):
        both = [
            {r["_key"]: round(r["score"], 6) for r in text_search(corpus, queries=queries, fields={"body": 1.0, "title": 2.0}, scorer=scorer, k=None, return_fields=[], **more).collect()}
            for more in ({**options, "index": index}, options)
        ]
        assert both[0] == both[1], scorer
    return set(both[0])


def test_index_after_appends_updates_and_removals(spark, corpus, tmp_path):
    first, second = corpus.where("_key in ('a', 'b')"), corpus.where("_key not in ('a', 'b')")
    index = TextIndex.build(first, ["body", "title"], str(tmp_path / "index"), buckets=2)
    index.append(second)
    changed = corpus.where("_key = 'a'").withColumn("body", F.lit("a slow wi-fi cat"))
    empty = corpus.where("_key = 'd'").withColumn("body", F.lit(None).cast("string")).withColumn("title", F.lit(""))
    index.append(changed.union(empty))
    now = corpus.where("_key not in ('a', 'd')").union(changed).union(empty)
    assert _same(index, now, "wi-fi cat slow dog")
    index.append(corpus.where("_key = 'a'"))  # the old text returns
    again = now.where("_key != 'a'").union(corpus.where("_key = 'a'"))
    assert "a" in _same(index, again)
    index.remove(spark.createDataFrame([("a",), ("never",)], "_key string"))
    left = again.where("_key != 'a'")
    _same(TextIndex.open(spark, str(tmp_path / "index")), left)
    index.append(corpus.where("_key = 'a'"))
    index.append(corpus.limit(0))
    assert "a" in _same(index, again)


def test_index_segment_written_again(spark, corpus, tmp_path):
    index = TextIndex.build(corpus.where("_key = 'a'"), ["body", "title"], str(tmp_path / "index"), buckets=4)
    late = corpus.where("_key != 'a'")
    assert index.append(late) == 1 and index.append(late, segment=1) == 1
    # A segment without statistics does not count yet, and the next one takes its place.
    late.select(F.col("_key"), F.lit("body").alias("field"), F.lit(1).alias("length"), F.lit(1).alias("peak"), F.lit("dog").alias("term"), F.lit(1).alias("tf"), F.array(F.lit(0)).alias("positions"), F.lit(3).alias("_bucket")).write.partitionBy("_bucket").parquet(str(tmp_path / "index/postings/_segment=2"))
    _same(index, corpus)
    assert index.append(corpus.limit(0)) == 2
    _same(index, corpus)
    with pytest.raises(QueryError):
        index.append(late, segment=9)


def test_index_of_an_empty_table_and_foreign_settings(spark, corpus, tmp_path):
    index = TextIndex.build(corpus.limit(0), ["body", "title"], str(tmp_path / "index"), stem=True, buckets=2)
    queries = spark.createDataFrame([(1, "jumping")], "query_id int, text string")
    assert text_search(corpus.limit(0), queries=queries, index=index, fields="body", stem=True, return_fields=[]).count() == 0
    index.append(corpus)
    scan, found = ({r["_key"] for r in text_search(corpus, queries=queries, index=i, fields="body", stem=True, return_fields=[]).collect()} for i in (None, index))
    assert scan == found == {"a"}
    for options in (dict(fields="body"), dict(fields="body", stem=True, sound=True), dict(fields="_key", stem=True)):
        with pytest.raises(QueryError):
            text_search(corpus, queries=queries, index=index, return_fields=[], **options).collect()


def test_positions_of_many_rows_are_those_of_each_alone(spark, monkeypatch):
    import pyarrow as pa

    from lakesearch.functions import text

    rows = [["b", "a", "b"], [], None, ["c"], ["a"] * 5, ["b", "c", "b", "c"]]
    whole = text.term_positions.func(pa.array(rows, pa.list_(pa.string()))).to_pylist()
    monkeypatch.setattr(text, "_TOKENS", 4)
    seen = []
    sort = text._sorted_terms
    monkeypatch.setattr(text, "_sorted_terms", lambda words, lengths: seen.append(int(lengths.sum())) or sort(words, lengths))
    parts = text.term_positions.func(pa.array(rows, pa.list_(pa.string()))).to_pylist()
    as_dicts = lambda found: [{e["term"]: (e["tf"], e["positions"]) for e in r} for r in found]
    assert as_dicts(parts) == as_dicts(whole)
    assert as_dicts(parts)[0] == {"b": (2, [0, 2]), "a": (1, [1])} and parts[1] == parts[2] == []
    assert max(seen) <= 5 and len(seen) > 2
    empty = text.term_positions.func(pa.array([], pa.list_(pa.string())))
    assert len(empty) == 0


def test_the_greatest_frequency_needs_no_python(spark):
    rows = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,), (["c", "a", "c", "a", "a"],)], "w array<string>")
    found = rows.select(max_frequency(F.col("w")).alias("m"))
    assert [r["m"] for r in found.collect()] == [2, 0, 0, 3]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in found._jdf.queryExecution().executedPlan().toString()
