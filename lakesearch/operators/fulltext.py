"""Ranked text search over one or more text fields.

Three ways to reach the term frequencies share one scoring formula:

* one query text: its terms are literals, frequencies are counted inside each
  document row, and nothing but the best rows is shuffled;
* a table of queries: document tokens are joined with the query terms, which are
  broadcast when their measured size allows and salted otherwise;
* a :class:`~lakesearch.operators.textindex.TextIndex`: term-clustered postings on disk.

Collection statistics always cover the whole table; the filter only decides which
documents may be returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Union

from pyspark.sql import Column, DataFrame, functions as F

from ..checks import finite, one_of, positive_int
from ..errors import QueryError
from ..functions.predicates import FilterInput, filter_column
from ..functions.text import (
    SPECIAL_CHARACTERS,
    analysed,
    is_plain,
    literal_tokens,
    max_frequency,
    porter_stem,
    query_tokens,
    resolve_stopwords,
    shingles,
)
from ..runtime import computed_once, equi_join, ranked, with_documents, written
from ..schema import DocumentSchema
from .besttext import best_documents
from .search import paged, project_fields, sorted_rows

SCORERS = ("BM25STD", "BM25", "TFIDF", "TFIDF.DOCNORM", "DISMAX", "DOCSCORE")
DECIMALS = 9

# The usual BM25 constants.
K1, B = 1.2, 0.75

TextFields = Union[str, Mapping[str, float]]


@dataclass(frozen=True)
class TextQuery:
    """Checked arguments of a text search."""

    fields: dict[str, float]
    scorer: str
    stopwords: frozenset[str]
    term_weights: dict[str, float]
    stem: bool
    sound: bool
    lower: bool = True

    @property
    def needs_statistics(self) -> bool:
        return self.scorer in ("BM25STD", "BM25", "TFIDF", "TFIDF.DOCNORM")


def text_search(
    df: DataFrame,
    text: str | None = None,
    fields: TextFields = "",
    scorer: str = "BM25STD",
    where: FilterInput = None,
    return_fields: Iterable[str] | None = None,
    k: int | None = 10,
    offset: int | None = None,
    limit: int | None = None,
    term_weights: Mapping[str, float] | None = None,
    stopwords: str | Iterable[str] | None = "english",
    stem: bool = False,
    sound: bool = False,
    doc_score: str | None = None,
    alias: str = "score",
    queries: DataFrame | None = None,
    query_id: str = "query_id",
    query_text: str = "text",
    index=None,
    schema: DocumentSchema | None = None,
    sort_by: str | None = None,
    sort_order: str | None = None,
) -> DataFrame:
    """Documents holding any query term, best score first, at most ``k`` per query.

    For a single text ``sort_by`` orders all matches by a field instead of the score,
    before the page is cut.

    ``fields`` is one field or a mapping of field to weight. ``term_weights`` weighs
    single words. ``k=None`` returns every match. A text whose tokens are all
    stopwords gives no rows.
    """
    query = text_query(fields, scorer, term_weights, stopwords, stem, sound)
    positive_int(k, "k")
    key = schema.key if schema is not None else "_key"
    if text is not None and queries is not None:
        raise QueryError("Pass either text or queries")
    if text is None and queries is None:
        raise QueryError("A text search needs a text or a table of queries")
    if sort_by is not None and text is None:
        raise QueryError("sort_by needs a single text")
    if sort_by is not None and index is not None:
        every = dict(scorer=scorer, where=where, k=None, term_weights=term_weights, stopwords=stopwords, stem=stem, sound=sound)
        found = text_search(df, text, fields, doc_score=doc_score, alias=alias, index=index, schema=schema, **every)
        found = sorted_rows(project_fields(found, schema, return_fields, [alias, sort_by]), sort_by, sort_order, key)
        return found if k is None else paged(found, offset, k if limit is None else limit)
    if queries is None and index is None:
        terms = literal_terms(text, query)
        found = _search_literal(df, terms, query, where, key, alias, doc_score, schema)
        page = k if limit is None else limit
        found = project_fields(found, schema, return_fields, [alias, *([sort_by] if sort_by else [])])
        if sort_by is not None:
            found = sorted_rows(found, sort_by, sort_order, key)
        if k is None:
            return found
        return paged(found if sort_by else found.orderBy(F.desc(alias), key), offset, page)
    if queries is None:
        queries = df.sparkSession.createDataFrame([(0, text)], "_query long, _text string")
        single, query_id, query_text = True, "_query", "_text"
    else:
        single = False
    first = offset or 0
    page = k if limit is None else limit
    most = None if k is None else first + page
    hits = batch_scores(df, queries, query_id, query_text, query, where, key, alias, doc_score, index, schema, most)
    if k is not None:
        hits = ranked(hits, [query_id], [F.desc(alias), F.col(key)], first + page, "_rank").where(F.col("_rank") > first).drop("_rank")
    if return_fields is None or list(return_fields):
        wide = project_fields(df, schema, return_fields)
        most = queries.count() * (k if limit is None else limit) if k is not None else None
        hits = with_documents(wide, hits, key, most)
        hits = hits.select(query_id, key, *[c for c in wide.columns if c != key], alias)
    return hits.drop(query_id).orderBy(F.desc(alias), key) if single else hits


def text_query(
    fields: TextFields,
    scorer: str = "BM25STD",
    term_weights: Mapping[str, float] | None = None,
    stopwords: str | Iterable[str] | None = "english",
    stem: bool = False,
    sound: bool = False,
    lower: bool = True,
) -> TextQuery:
    one_of(scorer, SCORERS, "scorer")
    return TextQuery(
        _field_weights(fields), scorer, resolve_stopwords(stopwords), _term_weights(term_weights), stem, sound, lower
    )


def _field_weights(fields: TextFields) -> dict[str, float]:
    if isinstance(fields, str):
        if not fields:
            raise QueryError("A text search needs the name of a text field")
        return {fields: 1.0}
    if not isinstance(fields, Mapping) or not fields:
        raise QueryError("fields must be a field name or a non-empty mapping of field to weight")
    for name, weight in fields.items():
        if not name:
            raise QueryError("Field names must be non-empty")
        if not finite(weight) or weight <= 0:
            raise QueryError(f"Field '{name}' needs a positive finite weight, not {weight!r}")
    return {name: float(weight) for name, weight in fields.items()}


def _term_weights(weights: Mapping[str, float] | None) -> dict[str, float]:
    out = {}
    for raw, weight in (weights or {}).items():
        word = raw.strip().lower()
        if not word or re.search(r"\s", word):
            raise QueryError(f"Only individual words may be weighted, got {raw!r}")
        if not finite(weight) or weight < 0:
            raise QueryError(f"Weight of '{word}' must be a non-negative number, got {weight!r}")
        out[word] = float(weight)
    return out


# -- query terms ---------------------------------------------------------------


def literal_terms(text: str, query: TextQuery) -> dict[str, float]:
    """Term to weight of one query text; a term of several words is a phrase."""
    terms: dict[str, float] = {}
    for raw in text.split():
        token = raw.strip(",").replace("“", "").replace("”", "").lower()
        plain = not any(c in SPECIAL_CHARACTERS for c in token)
        if plain and token in query.stopwords:
            continue
        words = literal_tokens(token)
        if not words:
            continue
        if query.stem:
            words = [porter_stem(w) for w in words]
        term = " ".join(words)
        weight = query.term_weights.get(token, 1.0) if plain else 1.0
        terms[term] = terms.get(term, 0.0) + weight
    return terms


def query_terms(queries: DataFrame, query_id: str, query_text: str, query: TextQuery) -> DataFrame:
    """``(query_id, term, weight, words)`` for a table of query texts."""
    token = F.col("_token")
    rows = queries.select(F.col(f"`{query_id}`"), F.explode(query_tokens(F.col(f"`{query_text}`"))).alias("_token"))
    rows = rows.withColumn("_plain", is_plain(token))
    if query.stopwords:
        rows = rows.where(~(F.col("_plain") & token.isin(*sorted(query.stopwords))))
    weight = F.lit(1.0)
    if query.term_weights:
        table = F.create_map(*[F.lit(x) for pair in query.term_weights.items() for x in pair])
        weight = F.when(F.col("_plain"), F.coalesce(table[token], F.lit(1.0))).otherwise(F.lit(1.0))
    words = analysed(token, query.stem, query.sound)
    rows = rows.select(query_id, F.array_join(words, " ").alias("term"), F.size(words).alias("words"), weight.alias("weight"))
    return rows.where("words > 0").groupBy(query_id, "term", "words").agg(F.sum("weight").alias("weight"))


# -- scoring -------------------------------------------------------------------


def term_score(
    scorer: str, tf: Column, length: Column, peak: Column, holders: Column, total: Column, mean: Column
) -> Column:
    """Unweighted score of one term in one field of one document.

    ``length`` is the field's token count, ``peak`` the count of its most frequent
    token, ``holders`` the number of documents with the term among ``total``, and
    ``mean`` the average length.
    """
    tf = tf.cast("double")
    if scorer in ("BM25STD", "BM25"):
        ratio = (total - holders + 0.5) / (holders + 0.5)
        idf = F.ln(ratio + 1.0) if scorer == "BM25STD" else F.greatest(F.ln(ratio), F.lit(0.0))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
    if scorer in ("TFIDF", "TFIDF.DOCNORM"):
        base = tf * F.ln(total / holders + 1.0)
        return base / (peak if scorer == "TFIDF" else length)
    return tf


def _search_literal(
    df: DataFrame,
    terms: dict[str, float],
    query: TextQuery,
    where: FilterInput,
    key: str,
    alias: str,
    doc_score: str | None,
    schema: DocumentSchema | None,
) -> DataFrame:
    if not terms:
        return df.where(F.lit(False)).withColumn(alias, F.lit(0.0))
    names = list(query.fields)
    lengths = sorted({t.count(" ") + 1 for t in terms})
    words = {
        f"_tokens{f}": analysed(_text_column(schema, name), query.stem, query.sound) for f, name in enumerate(names)
    }
    found: dict[str, Column] = {}
    for f in range(len(names)):
        tokens = F.col(f"_tokens{f}")
        # One pass keeps the few terms that matter; each term is then counted in that short list.
        found[f"_hits{f}"] = F.filter(shingles(tokens, lengths), lambda t: t.isin(*terms))
        found[f"_length{f}"] = F.size(tokens)
    counted = computed_once(computed_once(df, **words), **found)
    statistics = _literal_statistics(counted, names, list(terms)) if query.needs_statistics else None
    condition = filter_column(where, df, schema)
    if condition is not None:
        counted = counted.where(condition)
    matched = counted.where(
        reduce(lambda a, b: a | b, [F.coalesce(F.size(f"_hits{f}") > 0, F.lit(False)) for f in range(len(names))])
    )
    if query.scorer == "TFIDF":
        matched = computed_once(matched, **{f"_peak{f}": max_frequency(F.col(f"_tokens{f}")) for f in range(len(names))})
    parts = []
    for f, name in enumerate(names):
        total = F.lit(0.0)
        for i, (term, weight) in enumerate(terms.items()):
            tf = _occurrences(F.col(f"_hits{f}"), term)
            score = term_score(
                query.scorer,
                tf,
                F.col(f"_length{f}"),
                F.col(f"_peak{f}") if query.scorer == "TFIDF" else F.lit(1),
                F.lit(float(statistics[f"n{f}_{i}"] or 0) if statistics else 0.0),
                F.lit(float(statistics["total"]) if statistics else 0.0),
                F.lit(float(statistics[f"mean{f}"] or 1.0) if statistics else 1.0),
            )
            total = total + F.when(tf > 0, score * weight).otherwise(0.0)
        parts.append(F.coalesce(total, F.lit(0.0)) * query.fields[name])
    if query.scorer == "DOCSCORE":
        score = F.col(f"`{doc_score}`").cast("double") if doc_score else F.lit(1.0)
    elif query.scorer == "DISMAX" and len(parts) > 1:
        score = F.greatest(*parts)
    else:
        score = reduce(lambda a, b: a + b, parts)
    scored = matched.withColumn(alias, F.round(score, DECIMALS))
    return scored.select(*[F.col(f"`{c}`") for c in df.columns if c != alias], alias)


def _occurrences(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda t: t == term))


def _literal_statistics(counted: DataFrame, names: list[str], terms: list[str]):
    """One row: document count, mean length per field, holders per field and term."""
    wanted = [F.count(F.lit(1)).alias("total")]
    for f in range(len(names)):
        wanted.append(F.avg(f"_length{f}").alias(f"mean{f}"))
        for i, term in enumerate(terms):
            wanted.append(F.count_if(F.array_contains(f"_hits{f}", term)).alias(f"n{f}_{i}"))
    return counted.agg(*wanted).first()


def batch_scores(
    df: DataFrame,
    queries: DataFrame,
    query_id: str,
    query_text: str,
    query: TextQuery,
    where: FilterInput,
    key: str,
    alias: str,
    doc_score: str | None,
    index,
    schema: DocumentSchema | None,
    most: int | None = None,
) -> DataFrame:
    """``(query_id, key, score)`` of every match for a table of query texts; with ``most`` of the best ones at least."""
    terms = query_terms(queries, query_id, query_text, query)
    condition = filter_column(where, df, schema)
    if index is not None:
        postings, holders, statistics = index.lookup(terms.select("term", "words").distinct(), list(query.fields), query.stem, query.sound)
        if condition is not None:
            allowed = df.where(condition).select(key)
            postings = postings.join(allowed, key, "left_semi")
    else:
        postings, holders, statistics = _scan_postings(df, terms, query, condition, key, schema)
    score = term_score(
        query.scorer,
        F.col("tf"),
        F.col("length"),
        F.col("peak"),
        F.col("holders").cast("double"),
        F.lit(float(statistics.get("total", 0))),
        _lookup(F.col("field"), {f: statistics.get(f"mean:{f}") or 1.0 for f in query.fields}, 1.0),
    )
    weight = _lookup(F.col("field"), query.fields, 1.0)
    parts = equi_join(postings, holders, ["field", "term"], F.col(f"`{key}`")).select(key, "field", "term", (score * weight).alias("_part"))
    if most is not None and query.scorer != "DOCSCORE":
        weighed = terms.select(query_id, "term", "weight")
        return best_documents(parts, weighed, list(query.fields), query_id, key, most, alias, query.scorer == "DISMAX")
    hits = equi_join(parts, terms.select(query_id, "term", "weight"), ["term"], F.col(f"`{key}`"))
    hits = hits.withColumn("_part", F.col("_part") * F.col("weight"))
    if query.scorer == "DISMAX":
        hits = hits.groupBy(query_id, key, "field").agg(F.sum("_part").alias("_part"))
        return hits.groupBy(query_id, key).agg(F.round(F.max("_part"), DECIMALS).alias(alias))
    hits = hits.groupBy(query_id, key).agg(F.round(F.sum("_part"), DECIMALS).alias(alias))
    if query.scorer == "DOCSCORE":
        if doc_score is None:
            return hits.withColumn(alias, F.lit(1.0))
        prior = df.select(key, F.col(f"`{doc_score}`").cast("double").alias("_prior"))
        hits = with_documents(prior, hits, key, None)
        return hits.select(query_id, key, F.round("_prior", DECIMALS).alias(alias))
    return hits


def _scan_postings(
    df: DataFrame,
    terms: DataFrame,
    query: TextQuery,
    condition: Column | None,
    key: str,
    schema: DocumentSchema | None,
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Postings of the terms the queries use, holders per term, and collection statistics.

    All three come from one pass that tokenises every text once: each document also
    emits an empty term without key, which the map side collapses to one row per task.
    The few matching postings are written, because they are read twice.
    """
    vocabulary = terms.select("term", "words").distinct()
    lengths = [r[0] for r in vocabulary.select("words").distinct().collect()] or [1]
    allowed = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    rows = df.withColumn("_allowed", allowed).select("*", field_tokens(df, query.fields, schema, query.stem, query.sound))
    words = F.col("_words")
    peak = max_frequency(words) if query.scorer == "TFIDF" else F.lit(1)
    found = F.concat(F.array(F.lit("")), F.coalesce(shingles(words, lengths), F.array().cast("array<string>")))
    rows = computed_once(
        rows.select(key, "_allowed", "field", "_words"), length=F.size(words), peak=peak, _terms=found
    )
    rows = rows.select(key, "_allowed", "field", "length", "peak", F.explode("_terms").alias("term"))
    wanted = vocabulary.select("term").unionByName(df.sparkSession.range(1).select(F.lit("").alias("term")))
    rows = equi_join(rows, wanted, ["term"], F.col(f"`{key}`"))
    owner = F.when(F.col("term") != "", F.col(f"`{key}`")).alias(key)
    everything = rows.groupBy(owner, "field", "term").agg(
        F.count(F.lit(1)).alias("tf"),
        F.max("length").alias("length"),
        F.max("peak").alias("peak"),
        F.bool_and("_allowed").alias("_allowed"),
        F.count("length").alias("_holding"),
        F.sum("length").alias("_total"),
    )
    everything = written(everything, "postings")
    statistics: dict[str, float] = {}
    for r in everything.where("term = ''").collect():
        statistics["total"] = r["tf"]
        statistics[f"mean:{r['field']}"] = (r["_total"] or 0) / r["_holding"] if r["_holding"] else 1.0
    postings = everything.where("term != ''").drop("_holding", "_total")
    holders = postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("holders"))
    return postings.where("_allowed").drop("_allowed"), holders, statistics


def field_tokens(
    df: DataFrame, fields: Iterable[str], schema: DocumentSchema | None, stem: bool = False, sound: bool = False
) -> Column:
    """One ``(field, _words)`` row per text field of a document."""
    names = list(fields)
    cells = []
    for name in names:
        cells += [F.lit(name), analysed(_text_column(schema, name), stem, sound)]
    return F.stack(F.lit(len(names)), *cells).alias("field", "_words")


def _text_column(schema: DocumentSchema | None, name: str) -> Column:
    spec = schema.field(name) if schema is not None else None
    return F.col(f"`{spec.alias if spec is not None else name}`")


def _lookup(column: Column, table: Mapping[str, float], default: float) -> Column:
    out = F.lit(float(default))
    for name, value in table.items():
        out = F.when(column == name, F.lit(float(value))).otherwise(out)
    return out

