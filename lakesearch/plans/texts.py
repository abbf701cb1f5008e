"""Reports for text analysis and ranked text search."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import Num, Tag
from ..functions.text import ENGLISH, SPECIAL_CHARACTERS, stemmed, term_positions, tokens
from ..operators.fulltext import query_terms, text_query, text_search
from ..operators.textindex import TextIndex
from ..runtime import shared_folder
from .tables import DOCUMENTS, PAGES, Report, table

_OUT = 6

_TEXT = "that restin heed, dans the ouron"
_TERMS = {"restin": 1.0, "heed": 1.0, "dans": 1.0, "ouron": 1.0}
_SPLIT = r"[^\p{L}\p{N}]+"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", _OUT) + F.lit(0.0))


def _search(text: str = _TEXT, **options):
    def run(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents")
        return _rounded(
            text_search(docs, text, options.get("fields", "text"), schema=DOCUMENTS,
                        **{"return_fields": ["lang"], **{k: v for k, v in options.items() if k != "fields"}})
        )

    return run


def _pages(**options):
    def run(spark, folder) -> DataFrame:
        pages = table(spark, folder, "pages")
        return _rounded(text_search(pages, "example restin html fr", {"url": 5.0, "html": 1.0}, schema=PAGES,
                                    return_fields=[], **options))

    return run


def benchmark_queries(spark, folder) -> DataFrame:
    """Every benchmark passage as a query."""
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _batch(indexed: bool = False, **options):
    def run(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents")
        index = None
        if indexed:
            index = TextIndex.build(docs, ["text"], shared_folder(spark, "text-index"), DOCUMENTS)
        found = text_search(docs, None, "text", queries=benchmark_queries(spark, folder), return_fields=[], index=index,
                            schema=DOCUMENTS, **options)
        return _rounded(found)

    return run


def _batch_after(change):
    """Every benchmark passage searched in an index that ``change(index, docs)`` brings up to all documents."""

    def run(spark, folder) -> DataFrame:
        docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
        index = change(docs, shared_folder(spark, "text-index"))
        return _rounded(text_search(docs, None, "text", queries=benchmark_queries(spark, folder), return_fields=[], index=index, schema=DOCUMENTS))

    return run


def _appended(docs: DataFrame, path: str) -> TextIndex:
    """One language first, all others as a second segment."""
    index = TextIndex.build(docs.where("lang = 'en'"), ["text"], path, DOCUMENTS)
    index.append(docs.where("lang is null or lang != 'en'"), DOCUMENTS)
    return index


def _updated(docs: DataFrame, path: str) -> TextIndex:
    """All documents, English ones with a foreign text at first, and one too many; then the right ones."""
    old = F.when(F.col("lang") == "en", F.concat_ws(" ", F.reverse("text"), F.lit("the rest heeds"))).otherwise(F.col("text"))
    extra = docs.agg((F.max("doc_id") + 1).alias("doc_id"), F.first("text").alias("text"), F.lit("en").alias("lang"))
    index = TextIndex.build(docs.withColumn("text", old).unionByName(extra), ["text"], path, DOCUMENTS)
    index.append(docs.where("lang = 'en'"), DOCUMENTS)
    index.remove(extra)
    return index


def _document_tokens(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    postings = docs.select("doc_id", F.inline(term_positions(tokens(F.col("text")))))
    return postings.select("doc_id", "term", F.col("tf").cast("bigint").alias("tf"))


def _query_tokens(**options):
    def run(spark, folder) -> DataFrame:
        query = text_query("text", **options)
        return query_terms(benchmark_queries(spark, folder), "query_id", "text", query)

    return run


def _stems(spark, folder) -> DataFrame:
    words = table(spark, folder, "documents").select(F.explode(tokens(F.col("text"))).alias("word"))
    words = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.withColumn("stem", F.element_at(stemmed(F.array("word")), 1))


# -- SQL ------------------------------------------------------------------------

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(ENGLISH))
_SPECIAL = "[" + "".join("\\" + c for c in SPECIAL_CHARACTERS).replace("'", "''") + "]"


def _tokens_of(column: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({column}), '{_SPLIT}'), lambda x: x <> '')"


def query_terms_sql(stopwords: str | None = _STOP, source: str = "benchmark", key: str = "item_id") -> str:
    raw = (
        f"SELECT {key} AS query_id, unnest(list_transform(regexp_split_to_array(text, '\\s+'), lambda t: "
        "lower(regexp_replace(regexp_replace(t, '^,+|,+$', '', 'g'), '[“”]', '', 'g')))) AS token "
        f"FROM {source}"
    )
    keep = "token <> ''"
    if stopwords:
        keep += f" AND (regexp_matches(token, '{_SPECIAL}') OR token NOT IN ({stopwords}))"
    words = _tokens_of("token")
    return (
        f"SELECT query_id, term, words, sum(weight) AS weight FROM (SELECT query_id, 1.0::DOUBLE AS weight, "
        f"array_to_string({words}, ' ') AS term, len({words})::INTEGER AS words FROM ({raw}) WHERE {keep}) "
        "WHERE words > 0 GROUP BY query_id, term, words"
    )


def scored_sql(
    terms: str,
    scorer: str = "BM25STD",
    source: str = "documents",
    key: str = "doc_id",
    fields: dict[str, float] | None = None,
) -> str:
    """``(query_id, key, score)`` of every match; ``terms`` gives (query_id, term, words, weight)."""
    fields = fields or {"text": 1.0}
    toks = " UNION ALL ".join(
        f"SELECT {key}, '{f}' AS field, {w}::DOUBLE AS fw, {_tokens_of(f)} AS toks FROM {source}" for f, w in fields.items()
    )
    idf = {
        "BM25STD": "ln((total - n + 0.5) / (n + 0.5) + 1.0)",
        "BM25": "greatest(ln((total - n + 0.5) / (n + 0.5)), 0.0)",
    }
    part = {
        "TFIDF": "tf * ln(total / n + 1.0) / peak",
        "TFIDF.DOCNORM": "tf * ln(total / n + 1.0) / length",
        "DISMAX": "tf",
        "DOCSCORE": "tf",
    }.get(scorer) or f"{idf[scorer]} * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))"
    peaks = join_peaks = ""
    if scorer == "TFIDF":
        peaks = (
            f"peaks AS (SELECT {key}, field, max(c)::DOUBLE AS peak FROM (SELECT {key}, field, term, count(*) AS c "
            f"FROM (SELECT {key}, field, unnest(toks) AS term FROM toks) GROUP BY ALL) GROUP BY ALL),"
        )
        join_peaks = f" JOIN peaks USING ({key}, field)"
    outer = f"SELECT query_id, {key}, round(sum(part), 9) AS score FROM scored GROUP BY query_id, {key}"
    if scorer == "DISMAX":
        outer = (
            f"SELECT query_id, {key}, round(max(part), 9) AS score FROM (SELECT query_id, {key}, field, sum(part) AS part "
            f"FROM scored GROUP BY query_id, {key}, field) GROUP BY query_id, {key}"
        )
    return f"""
    WITH terms AS ({terms}),
    toks AS ({toks}),
    lens AS (SELECT *, len(toks)::DOUBLE AS length FROM toks),
    grams AS (
      SELECT {key}, field, fw, length, unnest(CASE WHEN n = 1 THEN toks ELSE list_transform(
        range(1, greatest(len(toks) - n + 2, 1)), lambda i: array_to_string(toks[i:i + n - 1], ' ')) END) AS term
      FROM lens, (SELECT DISTINCT words AS n FROM terms)),
    tfs AS (SELECT {key}, field, fw, length, term, count(*)::DOUBLE AS tf FROM grams
      WHERE term IN (SELECT term FROM terms) GROUP BY ALL),
    {peaks}
    stats AS (SELECT field, count(*)::DOUBLE AS total, avg(length) AS mean FROM lens GROUP BY field),
    holders AS (SELECT field, term, count(*)::DOUBLE AS n FROM tfs GROUP BY ALL),
    scored AS (SELECT query_id, {key}, field, ({part}) * fw * weight AS part
      FROM tfs JOIN terms USING (term) JOIN holders USING (field, term) JOIN stats USING (field){join_peaks})
    {outer}"""


def _literal(terms: dict[str, float]) -> str:
    rows = ", ".join(f"(0, '{t}', {t.count(' ') + 1}, {w}::DOUBLE)" for t, w in terms.items())
    return f"SELECT * FROM (VALUES {rows}) v(query_id, term, words, weight)"


def _top(terms: dict[str, float] = _TERMS, where: str = "true", k: int = 10, score: str = "score", **options) -> str:
    return (
        f"SELECT doc_id, lang, round({score}, 6) + 0.0 AS score FROM ({scored_sql(_literal(terms), **options)}) "
        f"JOIN documents USING (doc_id) WHERE {where} ORDER BY score DESC, doc_id LIMIT {k}"
    )


def _ranked(where: str = "true", k: int = 10) -> str:
    return (
        f"SELECT query_id, doc_id, round(score, 6) + 0.0 AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
        f"ORDER BY score DESC, doc_id) AS r FROM ({scored_sql(query_terms_sql())}) JOIN documents USING (doc_id) WHERE {where}) "
        f"WHERE r <= {k}"
    )


def _pages_sql(scorer: str) -> str:
    terms = _literal({t: 1.0 for t in ("example", "restin", "html", "fr")})
    inner = scored_sql(terms, scorer, "pages", "page_id", {"url": 5.0, "html": 1.0})
    return f"SELECT page_id, round(score, 6) + 0.0 AS score FROM ({inner}) ORDER BY score DESC, page_id LIMIT 10"


# The raw tokens hold special characters, so each becomes a phrase of its words.
_PHRASES = "the-and, (heed) rest.on of/the"
_PHRASE_TERMS = {"the and": 1.0, "heed": 1.0, "rest on": 1.0, "of the": 1.0}

REPORTS: dict[str, Report] = {
    "X1_document_tokens": Report(
        _document_tokens,
        f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_tokens_of('text')}) AS term FROM documents) "
        "GROUP BY doc_id, term"),
    "X2_query_tokens": Report(_query_tokens(stopwords=None), query_terms_sql(None)),
    "X3_stopwords_english": Report(_query_tokens(), query_terms_sql()),
    "X3_stopwords_custom": Report(_query_tokens(stopwords=["rest", "heed", "ou"]), query_terms_sql("'rest', 'heed', 'ou'")),
    "X4_ranked_match": Report(_search(), _top()),
    "X4_ranked_match_filtered": Report(
        _search(where=Tag("lang").eq("fr") & Num("n_chars").gt(300)), _top(where="lang = 'fr' AND n_chars > 300")),
    "O1_text_sorted_page": Report(
        _search(sort_by="n_chars", sort_order="DESC", offset=3, limit=7),
        f"SELECT doc_id, lang, n_chars, score FROM ({_top(k=1_000_000_000)}) JOIN documents USING (doc_id, lang) ORDER BY n_chars DESC, doc_id LIMIT 7 OFFSET 3"),
    "X4_batch_match": Report(_batch(), _ranked()),
    "X4_batch_match_filtered": Report(
        _batch(where=Tag("lang").eq("en"), k=3), _ranked("lang = 'en'", 3)),
    "X4_index_after_append": Report(_batch_after(_appended), _ranked()),
    "X4_index_after_update": Report(_batch_after(_updated), _ranked()),
    "X4_indexed_batch_match": Report(_batch(indexed=True), _ranked()),
    "X5_bm25": Report(_search(scorer="BM25"), _top(scorer="BM25")),
    "X6_tfidf": Report(_search(scorer="TFIDF"), _top(scorer="TFIDF")),
    "X6_tfidf_docnorm": Report(_search(scorer="TFIDF.DOCNORM"), _top(scorer="TFIDF.DOCNORM")),
    "X7_dismax": Report(_pages(scorer="DISMAX"), _pages_sql("DISMAX")),
    "X8_docscore": Report(
        _search(scorer="DOCSCORE", doc_score="n_chars"), _top(scorer="DOCSCORE", score="n_chars::DOUBLE").replace(
            "ORDER BY score DESC", "ORDER BY n_chars DESC")),
    "X9_field_weights": Report(_pages(), _pages_sql("BM25STD")),
    "X10_token_weights": Report(
        _search("heed dans heed rest", term_weights={"Heed": 3.0, "dans": 0.0}),
        _top({"heed": 6.0, "dans": 0.0, "rest": 1.0})),
    "X11_only_stopwords": Report(
        _search("the and of"), "SELECT doc_id, lang, 0.0 AS score FROM documents WHERE false"),
    "X12_stemmed_search": Report(_search("resting heeded", stem=True)),
    "X12_stems": Report(_stems),
    "X13_phonetic_batch": Report(_batch(sound=True, k=3)),
    "X14_special_tokens_are_phrases": Report(_search(_PHRASES), _top(_PHRASE_TERMS)),
}
