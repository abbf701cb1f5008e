"""Reports for hybrid text and vector search."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.predicates import Tag, Text
from ..operators.ann import IvfIndex
from ..operators.hybrid import Knn, Linear, Range, Rrf, hybrid_search
from ..runtime import shared_folder
from .tables import MIXED, Report, table
from .texts import _literal, query_terms_sql, scored_sql
from .vectors import distance_sql, first_vector

_OUT = 6
_TEXT = "restin heed dans"
_TERMS = {"restin": 1.0, "heed": 1.0, "dans": 1.0}


def mixed(spark, folder) -> DataFrame:
    """Documents with the vector of the same number, where there is one."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    return table(spark, folder, "documents").join(vectors, "doc_id", "left")


def _hybrid(**options):
    def run(spark, folder) -> DataFrame:
        given = dict(options)
        if given.pop("ivf", False):
            # Documents are fetched by key for what is found, so the index need not hold their texts.
            index = IvfIndex.build(mixed(spark, folder).drop("text"), "embedding", shared_folder(spark, "ivf"), 16, schema=MIXED)
            given["method"] = Knn(10, index, 16)
        found = hybrid_search(mixed(spark, folder), _TEXT, given.pop("text_field", "text"), first_vector(spark, folder),
                              "embedding", schema=MIXED, **{"return_fields": ["lang"], **given})
        scores = [c for c in ("hybrid_score", "text_score", "vector_score") if c in found.columns]
        for c in scores:
            found = found.withColumn(c, F.round(c, _OUT) + F.lit(0.0))
        return found

    return run


def _batch(spark, folder) -> DataFrame:
    passages = table(spark, folder, "benchmark")
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    queries = passages.join(vectors, "item_id").withColumnRenamed("item_id", "query_id")
    found = hybrid_search(mixed(spark, folder), None, "text", None, "embedding", queries=queries, return_fields=[], schema=MIXED)
    return found.withColumn("hybrid_score", F.round("hybrid_score", _OUT) + F.lit(0.0))


_MIXED = "(SELECT d.*, e.embedding::DOUBLE[] AS x, e.label FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id)"
_FIRST = "SELECT 0 AS query_id, embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1"


def fused_sql(
    terms: str | None,
    queries: str = _FIRST,
    k: int = 10,
    radius: float | None = None,
    window: int = 20,
    vector_where: str = "true",
    text_where: str = "true",
    linear: tuple[float, float] | None = None,
) -> str:
    """``(query_id, doc_id, t, v, h)`` of every fused row."""
    text = scored_sql(terms) if terms else "SELECT 0 AS query_id, doc_id, 1.0 AS score FROM documents"
    cut = f"vr <= {min(k, window)}" if radius is None else f"d <= {radius} AND vr <= {window}"
    if linear is None:
        text_share, vector_share = "1.0 / (60 + tr)", "1.0 / (60 + vr)"
    else:
        text_share = f"{linear[0]} * score / max(score) OVER (PARTITION BY query_id)"
        vector_share = f"{linear[1]} * greatest((2.0 - d) / 2, 0.0)"
    return f"""
    SELECT query_id, doc_id, max(t) AS t, max(v) AS v, round(sum(s), 9) AS h FROM (
      SELECT query_id, doc_id, score AS t, NULL::DOUBLE AS v, {text_share} AS s FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS tr
        FROM ({text}) JOIN documents USING (doc_id) WHERE {text_where}) WHERE tr <= {window}
      UNION ALL
      SELECT query_id, doc_id, NULL, greatest((2.0 - d) / 2, 0.0), {vector_share} FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, doc_id) AS vr FROM (
          SELECT query_id, doc_id, {distance_sql()} AS d FROM {_MIXED}, ({queries})
          WHERE x IS NOT NULL AND {vector_where})) WHERE {cut})
    GROUP BY query_id, doc_id"""


def _page(select: str, order: str = "h DESC, doc_id", where: str = "true", limit: int = 10, offset: int = 0, **options) -> str:
    terms = options.pop("terms", _literal(_TERMS))
    return (
        f"SELECT {select} FROM ({fused_sql(terms, **options)}) JOIN documents USING (doc_id) WHERE {where} "
        f"ORDER BY {order} LIMIT {limit} OFFSET {offset}"
    )


_H = "doc_id, lang, round(h, 6) + 0.0 AS hybrid_score"
_BATCH_SQL = (
    "SELECT query_id, doc_id, round(h, 6) + 0.0 AS hybrid_score FROM (SELECT *, row_number() OVER "
    "(PARTITION BY query_id ORDER BY h DESC, doc_id) AS r FROM ("
    + fused_sql(
        query_terms_sql(None, "(SELECT b.* FROM benchmark b JOIN embeddings e ON b.item_id = e.vec_id)"),
        "SELECT item_id AS query_id, embedding::DOUBLE[] AS q FROM benchmark JOIN embeddings ON item_id = vec_id",
    )
    + ")) WHERE r <= 10"
)

REPORTS: dict[str, Report] = {
    "H1_candidate_union": Report(_hybrid(k=40), _page(_H, limit=40)),
    "H2_text_side_filter": Report(
        _hybrid(text_field=None, text_where=Text("text").eq("the and")),
        _page(_H, terms=None, text_where=r"contains(' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), "
              r"'[^\p{L}\p{N}]+'), lambda x: x <> ''), ' ') || ' ', ' the and ')")),
    "H3_vector_side_knn": Report(_hybrid(method=Knn(3)), _page(_H, k=3)),
    "H3_vector_side_ivf": Report(_hybrid(ivf=True), _page(_H)),
    "H4_vector_side_range": Report(_hybrid(method=Range(0.75)), _page(_H, radius=0.75)),
    "H5_vector_side_filter": Report(
        _hybrid(vector_where=Tag("lang").eq("de")), _page(_H, vector_where="lang = 'de'")),
    "H6_rank_fusion": Report(_hybrid(combine=Rrf(60, 5)), _page(_H, window=5)),
    "H7_linear_fusion": Report(_hybrid(combine=Linear(0.7, 0.3)), _page(_H, linear=(0.7, 0.3))),
    "H8_post_filter": Report(
        _hybrid(post_filter="@lang = 'en' AND @n_chars > 200"), _page(_H, where="lang = 'en' AND n_chars > 200")),
    "H9_sorted_output": Report(
        _hybrid(sort_by=[("lang", "DESC"), "n_chars"], return_fields=["lang", "n_chars"], offset=2, k=12,
                text_score_alias="text_score", vector_score_alias="vector_score"),
        _page("doc_id, lang, n_chars, round(t, 6) + 0.0 AS text_score, round(v, 6) + 0.0 AS vector_score, "
              "round(h, 6) + 0.0 AS hybrid_score", "lang DESC, n_chars, doc_id", limit=12, offset=2)),
    "H9_batch_hybrid": Report(_batch, _BATCH_SQL),
}
