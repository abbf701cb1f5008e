"""Hybrid search: text candidates and vector candidates fused into one ranking.

Both sides deliver at most ``window`` keys with scores per query, so the fusion
moves a few rows whatever the table size. Document columns are fetched for the
fused candidates only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any, Union

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..checks import natural_int, natural_number, one_of, positive_int, text_given, unit_interval
from ..errors import QueryError
from ..functions.distance import normalized
from ..functions.predicates import FilterInput, filtered
from ..functions.refs import expression_sql, field_column, reference_name
from ..runtime import ranked, with_documents
from ..schema import DocumentSchema
from .fulltext import text_search
from .search import project_fields
from .vectors import knn, search_metric, vector_range


@dataclass(frozen=True)
class Knn:
    """Vector side: the ``k`` nearest, exactly or through an inverted-file index."""

    k: int = 10
    index: Any = None
    nprobe: int | None = None

    def __post_init__(self) -> None:
        positive_int(self.k, "k")
        positive_int(self.nprobe, "nprobe")


@dataclass(frozen=True)
class Range:
    """Vector side: everything within ``radius``. The search is exact, so ``epsilon`` has no effect."""

    radius: float
    epsilon: float | None = None

    def __post_init__(self) -> None:
        if self.radius is None:
            raise QueryError("radius must be a non-negative number")
        natural_number(self.radius, "radius")
        natural_number(self.epsilon, "epsilon")


@dataclass(frozen=True)
class Rrf:
    """Reciprocal rank fusion."""

    constant: int = 60
    window: int = 20

    def __post_init__(self) -> None:
        positive_int(self.constant, "constant")
        positive_int(self.window, "window")


@dataclass(frozen=True)
class Linear:
    """Weighted sum of the scaled text score and the vector similarity."""

    alpha: float = 0.5
    beta: float = 0.5
    window: int = 20

    def __post_init__(self) -> None:
        unit_interval(self.alpha, "alpha")
        unit_interval(self.beta, "beta")
        positive_int(self.window, "window")


def hybrid_search(
    df: DataFrame,
    text: str | None = None,
    text_field: str | None = None,
    vector: Sequence[float] | None = None,
    vector_field: str = "",
    method: Union[Knn, Range] = Knn(),
    combine: Union[Rrf, Linear] = Rrf(),
    vector_where: FilterInput = None,
    text_where: FilterInput = None,
    post_filter: str | Column | None = None,
    scorer: str = "BM25STD",
    metric: str | None = None,
    text_score_alias: str | None = None,
    vector_score_alias: str | None = None,
    alias: str = "hybrid_score",
    return_fields: Iterable[str] | None = None,
    k: int = 10,
    offset: int = 0,
    sort_by: Iterable[tuple[str, str] | str] | None = None,
    no_sort: bool = False,
    queries: DataFrame | None = None,
    query_id: str = "query_id",
    query_text: str = "text",
    query_vector: str = "vector",
    index=None,
    schema: DocumentSchema | None = None,
) -> DataFrame:
    """The fused top ``k``, best first, for one query or for a table of queries.

    Without ``text_field`` the text side is every row that matches ``text_where``.
    ``post_filter`` sees the document columns and the score aliases of fused rows.
    """
    single = queries is None
    if single:
        text_given(text, "text")
        if vector is None or len(vector) == 0:
            raise QueryError("Vector cannot be empty")
    for name, value in (("post_filter", post_filter), ("text_score_alias", text_score_alias),
                        ("vector_score_alias", vector_score_alias), ("alias", alias)):
        if isinstance(value, str):
            text_given(value, name)
    positive_int(k, "k")
    natural_int(offset, "offset")
    order = _sort_pairs(sort_by)
    if no_sort and order:
        raise QueryError("no_sort cannot be used with sort_by")
    if text_field is None and text_where is None:
        raise QueryError("Give text_field, or text_where for a text side without tokens")
    metric = search_metric(schema, vector_field, metric)
    key = schema.key if schema is not None else "_key"
    query = "_query" if single else query_id
    sides = _Sides(df, schema, key, query, None if single else queries, query_text, query_vector)
    window = combine.window
    texts = sides.text(text, text_field, text_where, scorer, index, window)
    vectors = sides.vector(vector, vector_field, method, metric, vector_where, window)
    fused = _fused(texts, vectors, combine, metric, query, key, alias)
    kept = [c for c, a in (("_text", text_score_alias), ("_vector", vector_score_alias)) if a is not None]
    names = {"_text": text_score_alias, "_vector": vector_score_alias}
    fused = fused.select(query, key, *[F.col(c).alias(names[c]) for c in kept], alias)
    scores = [c for c in fused.columns if c not in (query, key)]

    wide = post_filter is not None or bool(order)
    if not wide:
        fused = _page(fused, [] if no_sort else [F.desc(alias)], query, key, offset, k)
    if wide or return_fields is None or list(return_fields):
        most = (1 if single else queries.count()) * (2 * window if wide else k)
        found = with_documents(df, fused, key, most)
        if post_filter is not None:
            found = found.where(F.expr(expression_sql(post_filter)) if isinstance(post_filter, str) else post_filter)
        if wide:
            columns = [
                field_column(found, n).desc() if d == "DESC" else field_column(found, n).asc() for n, d in order
            ]
            found = _page(found, columns or ([] if no_sort else [F.desc(alias)]), query, key, offset, k)
        columns = [c for c in df.columns] if return_fields is None else return_fields
        extra = [c for n, _ in order if (c := reference_name(n)) in found.columns]
        fused = project_fields(found, schema, columns, [*scores, query, *extra])
    if not no_sort:
        by = [F.col(f"`{reference_name(n)}`").desc() if d == "DESC" else F.col(f"`{reference_name(n)}`").asc() for n, d in order]
        if single:
            fused = fused.orderBy(*(by or [F.desc(alias)]), key)
    asked = None if return_fields is None else {reference_name(c) for c in return_fields}
    drop = [] if asked is None else [c for n, _ in order if (c := reference_name(n)) not in {*asked, *scores, key}]
    return fused.drop(*drop, *([query] if single else []))


@dataclass(frozen=True)
class _Sides:
    df: DataFrame
    schema: DocumentSchema | None
    key: str
    query: str
    queries: DataFrame | None
    query_text: str
    query_vector: str

    def text(self, text, field, where, scorer, index, window) -> DataFrame:
        """``(query, key, _text)`` of the best ``window`` text matches."""
        if field is None:
            found = filtered(self.df, where, self.schema).select(self.key).withColumn("_text", F.lit(1.0))
            found = found.orderBy(self.key).limit(window)
            if self.queries is None:
                return found.select(F.lit(0).alias(self.query), self.key, "_text")
            # Every query shares this bounded candidate list.
            shared = found.agg(F.collect_list(self.key).alias("_keys")).first()["_keys"]
            keys = F.array(*[F.lit(v) for v in shared]) if shared else F.array().cast(
                f"array<{self.df.schema[self.key].dataType.simpleString()}>"
            )
            return self.queries.select(self.query, F.explode(keys).alias(self.key)).withColumn("_text", F.lit(1.0))
        options = dict(
            scorer=scorer, where=where, return_fields=[], k=window, stopwords=None, alias="_text", schema=self.schema
        )
        if self.queries is None:
            found = text_search(self.df, text, field, index=index, **options)
            return found.select(F.lit(0).alias(self.query), self.key, "_text")
        return text_search(
            self.df, None, field, queries=self.queries, query_id=self.query, query_text=self.query_text,
            index=index, **options
        )

    def vector(self, vector, field, method, metric, where, window) -> DataFrame:
        """``(query, key, _distance)`` of the vector candidates."""
        options = dict(where=where, fields=[], metric=metric, alias="_distance", schema=self.schema)
        if self.queries is not None:
            options |= dict(queries=self.queries, query_id=self.query, query_vector=self.query_vector)
        if isinstance(method, Range):
            found = vector_range(self.df, vector, field, threshold=method.radius, **options)
            if self.queries is None:
                found = found.limit(window)
        elif method.index is not None:
            options.pop("metric")
            options.pop("schema")
            options["fields"] = []
            found = method.index.search(vector, k=min(method.k, window), nprobe=method.nprobe, **options)
        else:
            found = knn(self.df, vector, field, k=min(method.k, window), **options)
        if self.queries is None:
            return found.select(F.lit(0).alias(self.query), self.key, "_distance")
        return found.select(self.query, self.key, "_distance")


def _fused(
    texts: DataFrame, vectors: DataFrame, combine: Union[Rrf, Linear], metric: str, query: str, key: str, alias: str
) -> DataFrame:
    part = Window.partitionBy(query)
    texts = ranked(texts, [query], [F.desc("_text"), F.col(key)], combine.window, "_rank")
    vectors = ranked(vectors, [query], [F.col("_distance"), F.col(key)], combine.window, "_rank")
    similarity = F.lit(1.0) - F.col("_distance") if metric == "IP" else normalized(F.col("_distance"), metric)
    vectors = vectors.withColumn("_vector", similarity)
    if isinstance(combine, Rrf):
        share = F.lit(1.0) / (F.lit(float(combine.constant)) + F.col("_rank"))
        texts, vectors = texts.withColumn("_share", share), vectors.withColumn("_share", share)
    else:
        best = F.max("_text").over(part)
        scaled = F.coalesce(F.try_divide(F.col("_text"), best), F.lit(0.0))
        texts = texts.withColumn("_share", scaled * combine.alpha)
        vectors = vectors.withColumn("_share", F.col("_vector") * combine.beta)
    both = texts.select(query, key, "_text", F.lit(None).cast("double").alias("_vector"), "_share").unionByName(
        vectors.select(query, key, F.lit(None).cast("double").alias("_text"), "_vector", "_share")
    )
    return both.groupBy(query, key).agg(
        F.max("_text").alias("_text"), F.max("_vector").alias("_vector"), F.round(F.sum("_share"), 9).alias(alias)
    )


def _page(df: DataFrame, order: list[Column], query: str, key: str, offset: int, k: int) -> DataFrame:
    return ranked(df, [query], [*order, F.col(key)], offset + k, "_place").where(F.col("_place") > offset).drop("_place")


def _sort_pairs(sort_by: Iterable[tuple[str, str] | str] | None) -> list[tuple[str, str]]:
    pairs = [(s, "ASC") if isinstance(s, str) else (s[0], s[1] or "ASC") for s in sort_by or []]
    for name, direction in pairs:
        text_given(name, "sort field")
        one_of(direction, ("ASC", "DESC"), "sort direction")
    return [(name.strip(), direction) for name, direction in pairs]
