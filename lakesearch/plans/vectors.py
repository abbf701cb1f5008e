"""Reports for exact and approximate vector search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import Bands
from ..functions.predicates import Num
from ..operators.ann import IvfIndex, LshIndex
from ..operators.similarity import similarity_classes, similarity_join
from ..operators.vectors import knn, vector_range
from ..runtime import shared_folder
from .tables import EMBEDDINGS, Report, embeddings_schema, table

# Round for output only; ranking uses the nine decimals of the distance itself.
_OUT = 6
_LISTS = 16


def first_vector(spark: SparkSession, folder: str) -> list[float]:
    """The query vector: the one with the smallest id."""
    return list(table(spark, folder, "embeddings").orderBy("vec_id").select("embedding").first()[0])


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every stored vector as a query."""
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, _OUT) + F.lit(0.0))
    return df


def _knn(metric: str = "COSINE", **options):
    def run(spark, folder) -> DataFrame:
        schema = embeddings_schema(metric)
        found = knn(table(spark, folder, "embeddings"), first_vector(spark, folder), "embedding", schema=schema,
                    **{"fields": ["label"], **options})
        scores = [options.get("alias", "vector_distance"), *(["score"] if options.get("normalize") else [])]
        return _rounded(found, *scores)

    return run


def _range(metric: str = "COSINE", **options):
    def run(spark, folder) -> DataFrame:
        found = vector_range(table(spark, folder, "embeddings"), first_vector(spark, folder), "embedding", fields=["label"],
                             schema=embeddings_schema(metric), **options)
        return _rounded(found, "vector_distance", *(["score"] if options.get("normalize") else []))

    return run


def _batch_knn(spark, folder) -> DataFrame:
    docs = table(spark, folder, "embeddings")
    return _rounded(knn(docs, field="embedding", queries=vector_queries(spark, folder), schema=EMBEDDINGS), "vector_distance")


def _batch_knn_filtered(spark, folder) -> DataFrame:
    docs = table(spark, folder, "embeddings")
    found = knn(docs, field="embedding", k=3, where=Num("label").ge(5), fields=["label"],
                queries=vector_queries(spark, folder), schema=EMBEDDINGS)
    return _rounded(found, "vector_distance")


def _batch_range(spark, folder) -> DataFrame:
    docs = table(spark, folder, "embeddings")
    found = vector_range(docs, field="embedding", threshold=0.7, queries=vector_queries(spark, folder), schema=EMBEDDINGS)
    return _rounded(found, "vector_distance")


def _grid_knn(spark, folder) -> DataFrame:
    found = knn(table(spark, folder, "embeddings"), field="embedding", queries=vector_queries(spark, folder), schema=EMBEDDINGS, join="grid")
    return _rounded(found, "vector_distance")


def _grid_range(spark, folder) -> DataFrame:
    docs = table(spark, folder, "embeddings")
    found = vector_range(docs, field="embedding", threshold=0.7, where=Num("label").ge(5), queries=vector_queries(spark, folder), schema=EMBEDDINGS, join="grid")
    return _rounded(found, "vector_distance")


def _join(method: str):
    def run(spark, folder) -> DataFrame:
        found = similarity_join(table(spark, folder, "embeddings"), field="embedding", threshold=0.6, method=method,
                                schema=EMBEDDINGS, every=True)
        return _rounded(found, "distance")

    return run


def with_copies(spark, folder) -> DataFrame:
    """The embeddings, and every vector of label 3 twice more under other keys."""
    docs = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    again = docs.where("label = 3").withColumn("step", F.explode(F.array(F.lit(1_000_000), F.lit(2_000_000))))
    again = again.select((F.col("vec_id") + F.col("step")).alias("vec_id"), "embedding", "label")
    return docs.unionByName(again)


def _join_with_copies(spark, folder) -> DataFrame:
    pairs, members = similarity_classes(with_copies(spark, folder), "embedding", 0.6, "exact", schema=EMBEDDINGS)
    pairs = pairs.select(F.lit("pair").alias("part"), "left_key", "right_key", "distance")
    members = members.select(F.lit("member").alias("part"), F.col("representative").alias("left_key"), F.col("member").alias("right_key"), "distance")
    return _rounded(pairs.unionByName(members), "distance")


def _two_tables_with_copies(spark, folder) -> DataFrame:
    rows = with_copies(spark, folder)
    found = similarity_join(rows.where("label = 4"), rows.where("label = 3"), "embedding", 0.8, "exact", schema=EMBEDDINGS)
    return _rounded(found, "distance")


def _inner_product_copies(spark, folder) -> DataFrame:
    """Under the inner product a copy's distance is its own: unit vectors and their copies pair, shorter ones do not."""
    rows = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("_key"),
        F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == F.col("n_regionkey") % 4, F.when(F.col("n_regionkey") == 4, 0.5).otherwise(1.0)).otherwise(0.0)).alias("v"),
    )
    return similarity_join(rows, field="v", threshold=0.0, method="exact", metric="IP")


def _recall(found: DataFrame, true: DataFrame, on: list[str], least: float, alias: str) -> DataFrame:
    """One row: whether every found row is a true row, and whether at least ``least`` of these were found."""
    tagged = true.select(*on, F.lit(1).alias("_true")).join(found.select(*on, F.lit(1).alias("_found")), on, "full")
    return tagged.agg(
        F.coalesce(F.count("_found") == F.count(F.when(F.col("_true").isNotNull(), F.col("_found"))), F.lit(True)).alias("all_true"),
        (F.count(F.when(F.col("_true").isNotNull(), F.col("_found"))) >= least * F.count("_true")).alias(alias),
    )


def _join_recall(spark, folder) -> DataFrame:
    """Hash bands against the exact join: no wrong pair, nine tenths of the right ones."""
    return _recall(_join("lsh")(spark, folder), _join("exact")(spark, folder), ["left_key", "right_key", "distance"], 0.9, "enough")


def _one_recall(search, k: int, least: float, where=None):
    def run(spark, folder) -> DataFrame:
        found = search(spark, folder).select("vec_id", F.lit(1).alias("_found"))
        docs = table(spark, folder, "embeddings")
        true = knn(docs, first_vector(spark, folder), "embedding", k=k, where=where, fields=[], schema=EMBEDDINGS)
        hits = true.select("vec_id").join(found, "vec_id", "left").select(F.coalesce("_found", F.lit(0)).alias("hit"))
        return hits.agg((F.count("*") == k).alias("full_page"), (F.avg("hit") >= least).alias("enough"))

    return run


def _batch_recall(spark, folder) -> DataFrame:
    """Four of the lists for every query: recall against the exact answer, and exact distances."""
    found = _ivf_batch(spark, folder, 4).select("query_id", "vec_id", F.col("vector_distance").alias("d"))
    true = _batch_knn(spark, folder).select("query_id", "vec_id", F.col("vector_distance").alias("true_d"))
    both = true.join(found, ["query_id", "vec_id"], "left")
    return both.agg(
        (F.avg(F.col("d").isNotNull().cast("int")) >= 0.3).alias("enough"),
        F.coalesce(F.max(F.abs(F.col("d") - F.col("true_d"))) < 1e-6, F.lit(True)).alias("exact_distances"),
    )


def _calibrated_recall(where=None):
    """The lists that a tenth of the queries need, probed for all of them: recall against the exact answer."""

    def run(spark, folder) -> DataFrame:
        index, queries = ivf_index(spark, folder), vector_queries(spark, folder)
        nprobe = index.calibrate(queries.where("query_id % 10 = 0"), where=where)
        found = index.search(queries=queries, nprobe=nprobe, where=where, fields=[]).select("query_id", "vec_id", F.lit(1).alias("_found"))
        true = knn(table(spark, folder, "embeddings"), field="embedding", where=where, queries=queries, schema=EMBEDDINGS)
        both = true.join(found, ["query_id", "vec_id"], "left")
        return both.agg(F.count("*").alias("neighbours"), (F.count("_found") >= 0.9 * F.count("*")).alias("enough"))

    return run


def ivf_index(spark: SparkSession, folder: str, lists: int = _LISTS) -> IvfIndex:
    docs = table(spark, folder, "embeddings")
    return IvfIndex.build(docs, "embedding", shared_folder(spark, "ivf"), lists, schema=EMBEDDINGS)


def _ivf(**options):
    def run(spark, folder) -> DataFrame:
        found = ivf_index(spark, folder).search(first_vector(spark, folder), **{"fields": ["label"], **options})
        return _rounded(found, "vector_distance")

    return run


def _ivf_batch(spark, folder, nprobe: int = _LISTS) -> DataFrame:
    found = ivf_index(spark, folder).search(queries=vector_queries(spark, folder), nprobe=nprobe, fields=[])
    return _rounded(found, "vector_distance")


def _lsh(spark, folder) -> DataFrame:
    docs = table(spark, folder, "embeddings")
    index = LshIndex.build(docs, "embedding", shared_folder(spark, "lsh"), Bands(32, 4), schema=EMBEDDINGS)
    return _rounded(index.search(first_vector(spark, folder), fields=["label"]), "vector_distance")


def distance_sql(metric: str = "COSINE", x: str = "x", q: str = "q") -> str:
    if metric == "L2":
        return f"round(list_distance({x}, {q}), 9) + 0.0"
    dot = f"list_dot_product({x}, {q})"
    if metric == "COSINE":
        dot = f"{dot} / (sqrt(list_dot_product({x}, {x})) * sqrt(list_dot_product({q}, {q})))"
    return f"round(1.0 - {dot}, 9) + 0.0"


def _one(metric: str = "COSINE", where: str = "true") -> str:
    """Every row with its distance ``d`` to the first vector."""
    return (
        f"SELECT vec_id, label, {distance_sql(metric)} AS d FROM (SELECT vec_id, label, embedding::DOUBLE[] AS x, "
        "(SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1) AS q FROM embeddings) "
        f"WHERE {where}"
    )


def _top(metric: str = "COSINE", k: int = 10, where: str = "true", extra: str = "", alias: str = "vector_distance") -> str:
    return (
        f"SELECT vec_id, label, round(d, 6) + 0.0 AS {alias}{extra} FROM ({_one(metric, where)}) ORDER BY d, vec_id LIMIT {k}"
    )


_PAIRS = (
    f"SELECT a.vec_id AS query_id, b.vec_id AS vec_id, b.label AS label, {distance_sql('COSINE', 'b.x', 'a.x')} AS d "
    "FROM (SELECT *, embedding::DOUBLE[] AS x FROM embeddings) a, (SELECT *, embedding::DOUBLE[] AS x FROM embeddings) b"
)


def _best(k: int, where: str = "true", extra: str = "") -> str:
    return (
        f"SELECT query_id, vec_id{extra}, round(d, 6) + 0.0 AS vector_distance FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY query_id ORDER BY d, vec_id) AS r FROM ({_PAIRS}) WHERE {where}) WHERE r <= {k}"
    )


_COSINE_SCORE = ", round(greatest((2.0 - d) / 2, 0.0), 6) + 0.0 AS score"
_L2_SCORE = ", round(1.0 / (1.0 + d), 6) + 0.0 AS score"

REPORTS: dict[str, Report] = {
    "V1_knn": Report(_knn(), _top()),
    "V2_knn_l2": Report(_knn("L2"), _top("L2")),
    "V2_knn_inner_product": Report(_knn("IP"), _top("IP")),
    "V3_filtered_knn": Report(_knn(where=Num("label").eq(2)), _top(where="label = 2")),
    "V4_knn_page": Report(
        _knn(k=30, offset=5, limit=8),
        f"SELECT * FROM ({_top(k=30)}) ORDER BY vector_distance, vec_id LIMIT 8 OFFSET 5"),
    "V5_normalized_cosine": Report(_knn(normalize=True), _top(extra=_COSINE_SCORE)),
    "V5_normalized_l2": Report(_knn("L2", normalize=True), _top("L2", extra=_L2_SCORE)),
    "V5_normalized_inner_product_untouched": Report(
        _knn("IP", normalize=True), _top("IP", extra=", round(d, 6) + 0.0 AS score")),
    "V6_range": Report(
        _range(threshold=0.8), f"SELECT vec_id, label, round(d, 6) + 0.0 AS vector_distance FROM ({_one()}) WHERE d <= 0.8"),
    "V6_range_identical": Report(
        _range(threshold=0), f"SELECT vec_id, label, round(d, 6) + 0.0 AS vector_distance FROM ({_one()}) WHERE d <= 0"),
    "V6_range_filtered_page": Report(
        _range(threshold=0.95, where=Num("label").lt(5), offset=2, limit=20, normalize=True),
        f"SELECT vec_id, label, round(d, 6) + 0.0 AS vector_distance{_COSINE_SCORE} FROM ({_one(where='label < 5')}) "
        "WHERE d <= 0.95 ORDER BY d, vec_id LIMIT 20 OFFSET 2"),
    "V7_batch_knn": Report(_batch_knn, _best(10)),
    "V7_batch_knn_filtered": Report(_batch_knn_filtered, _best(3, "label >= 5", ", label")),
    "V7_batch_range": Report(
        _batch_range, f"SELECT query_id, vec_id, round(d, 6) + 0.0 AS vector_distance FROM ({_PAIRS}) WHERE d <= 0.7"),
    "V7_grid_knn": Report(_grid_knn, _best(10)),
    "V7_grid_range": Report(
        _grid_range, f"SELECT query_id, vec_id, round(d, 6) + 0.0 AS vector_distance FROM ({_PAIRS}) WHERE d <= 0.7 AND label >= 5"),
    "V8_similarity_join_exact": Report(
        _join("exact"),
        f"SELECT query_id AS left_key, vec_id AS right_key, round(d, 6) + 0.0 AS distance FROM ({_PAIRS}) "
        "WHERE query_id < vec_id AND d <= 0.6"),
    "V8_similarity_join_lsh": Report(_join("lsh")),
    "V8_join_recall": Report(_join_recall, "SELECT true AS all_true, true AS enough"),
    "V8_join_with_copies": Report(
        _join_with_copies,
        f"WITH every AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings UNION ALL SELECT vec_id + step, embedding::DOUBLE[] "
        f"FROM embeddings, (VALUES (1000000), (2000000)) s(step) WHERE label = 3), heads AS (SELECT min(vec_id) AS vec_id, x FROM every GROUP BY x) "
        f"SELECT 'member' AS part, h.vec_id AS left_key, e.vec_id AS right_key, 0.0::DOUBLE AS distance FROM heads h JOIN every e ON h.x = e.x "
        f"WHERE h.vec_id <> e.vec_id UNION ALL SELECT 'pair', left_key, right_key, round(d, 6) + 0.0 FROM (SELECT a.vec_id AS left_key, "
        f"b.vec_id AS right_key, {distance_sql('COSINE', 'b.x', 'a.x')} AS d FROM heads a, heads b WHERE a.vec_id < b.vec_id) WHERE d <= 0.6"),
    "V8_two_tables_with_copies": Report(
        _two_tables_with_copies,
        f"SELECT left_key, right_key + step AS right_key, round(d, 6) + 0.0 AS distance FROM (SELECT a.vec_id AS left_key, b.vec_id AS right_key, "
        f"{distance_sql('COSINE', 'b.x', 'a.x')} AS d FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE label = 4) a, "
        "(SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE label = 3) b), (VALUES (0), (1000000), (2000000)) s(step) WHERE d <= 0.8"),
    "V8_inner_product_copies": Report(
        _inner_product_copies,
        "SELECT min(h.n_nationkey) AS left_key, n.n_nationkey AS right_key, 0.0::DOUBLE AS distance FROM nation n JOIN nation h USING (n_regionkey) "
        "WHERE n_regionkey < 4 GROUP BY n.n_nationkey HAVING min(h.n_nationkey) <> n.n_nationkey"),
    "V9_some_lists_recall": Report(
        _one_recall(_ivf(nprobe=4), 10, 0.2), "SELECT true AS full_page, true AS enough"),
    "V9_batch_recall": Report(_batch_recall, "SELECT true AS enough, true AS exact_distances"),
    "V9_calibrated_recall": Report(
        _calibrated_recall(), f"SELECT count(*) AS neighbours, true AS enough FROM ({_best(10)})"),
    "V9_calibrated_recall_filtered": Report(
        _calibrated_recall(Num("label").ge(5)), f"SELECT count(*) AS neighbours, true AS enough FROM ({_best(10, 'label >= 5')})"),
    "V10_lsh_recall": Report(_one_recall(lambda s, d: _lsh(s, d), 10, 0.9), "SELECT true AS full_page, true AS enough"),
    "V11_probe_batches_recall": Report(
        _one_recall(_ivf(where=Num("label").eq(3), policy="BATCHES", batch_size=2), 10, 0.2, Num("label").eq(3)),
        "SELECT true AS full_page, true AS enough"),
    "V9_ivf_all_lists": Report(_ivf(nprobe=_LISTS), _top()),
    "V9_ivf_some_lists": Report(_ivf(nprobe=4)),
    "V9_ivf_batch_all_lists": Report(_ivf_batch, _best(10)),
    "V9_ivf_batch_some_lists": Report(lambda s, d: _ivf_batch(s, d, 4)),
    "V10_lsh_bands": Report(_lsh),
    "V11_filter_first": Report(_ivf(where=Num("label").eq(3), policy="ADHOC_BF"), _top(where="label = 3")),
    "V11_probe_batches": Report(_ivf(where=Num("label").eq(3), policy="BATCHES", batch_size=2)),
    "V12_score_alias": Report(_knn(alias="nearness"), _top(alias="nearness")),
}
