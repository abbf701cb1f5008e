from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesearch.errors import QueryError
from lakesearch.functions import distance
from lakesearch.functions.distance import denormalized_cosine, normalized
from lakesearch.functions.hashing import Bands
from lakesearch.functions.predicates import Num, Tag
from lakesearch.operators import ann, similarity, vectors
from lakesearch.operators.ann import IvfIndex, LshIndex
from lakesearch.operators.similarity import similarity_join
from lakesearch.operators.vectors import knn, vector_range
from lakesearch.plans.vectors import REPORTS
from lakesearch.schema import DocumentSchema

ONE = [1.0, 0.0, 0.0, 0.0]


def frame(spark, x, extra=None):
    rows = [(i, [float(v) for v in row], (int(extra[i]) if extra is not None else 0)) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "_key long, v array<double>, label long")


def brute(x, q, metric):
    if metric == "L2":
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
    else:
        d = x @ q
        if metric == "COSINE":
            with np.errstate(invalid="ignore"):
                d = d / np.sqrt((x * x).sum(axis=1) * (q * q).sum())
        d = 1 - d
    return np.round(d, 9)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16)) * 3
    return centers[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.6


def test_known_ranges(products, product_schema, keys_of):
    def search(**options):
        return keys_of(vector_range(products, ONE, "embedding", fields=[], schema=product_schema, **options))

    assert search() == ["1", "3", "6"]
    assert search(where=Tag("brand").eq("acme")) == ["1", "6"]
    assert search(threshold=0) == ["1"]
    assert search(offset=1, limit=1) == ["3"]


def test_knn_orders_pages_and_filters(products, product_schema, keys_of):
    found = knn(products, ONE, "embedding", k=3, fields=["price"], normalize=True, alias="d", schema=product_schema)
    assert found.columns == ["_key", "price", "d", "score"] and keys_of(found) == ["1", "3", "6"]
    first = found.first()
    assert first["d"] == 0.0 and first["score"] == 1.0
    assert keys_of(knn(products, ONE, "embedding", k=4, offset=1, limit=2, schema=product_schema)) == ["3", "6"]
    assert keys_of(knn(products, ONE, "embedding", k=2, where=Num("price").lt(300), schema=product_schema)) == ["3", "2"]
    assert keys_of(knn(products, ONE, "embedding", k=3, sort_by="price", sort_order="ASC", fields=[], schema=product_schema)) == ["3", "6", "1"]
    assert len(keys_of(knn(products, ONE, "embedding", k=20, offset=0, schema=product_schema))) == 6


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_all_paths_agree_with_brute_force(spark, clustered, metric):
    x = np.vstack([clustered[:300], clustered[:20], np.zeros((1, 16))])
    docs = frame(spark, x).repartition(5)
    d = {i: brute(x, x[i], metric) for i in (0, 7, 150)}
    queries = spark.createDataFrame([(i, x[i].tolist()) for i in d], "query_id long, vector array<double>")
    many = knn(docs, field="v", k=12, metric=metric, queries=queries)
    limit = max(0.0, float(np.nanquantile(d[0], 0.1)))
    near = vector_range(docs, field="v", threshold=limit, metric=metric, queries=queries)
    for i, dist in d.items():
        order = [j for j in np.lexsort((np.arange(len(x)), dist)) if not np.isnan(dist[j])]
        one = [(r["_key"], r["vector_distance"]) for r in knn(docs, x[i], "v", k=12, metric=metric, fields=[]).collect()]
        assert [k for k, _ in one] == order[:12]
        batch = many.where(F.col("query_id") == i).orderBy("vector_distance", "_key").collect()
        assert [(r["_key"], r["vector_distance"]) for r in batch] == one
        assert {r["_key"] for r in near.where(F.col("query_id") == i).collect()} == {j for j in order if dist[j] <= limit}


def test_queries_in_several_blocks_give_the_same_rows(spark, clustered, monkeypatch):
    docs = frame(spark, clustered[:200])
    queries = docs.select(F.col("_key").alias("query_id"), F.col("v").alias("vector"))
    whole = set(knn(docs, field="v", k=3, queries=queries).collect())
    monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", 5000)
    monkeypatch.setattr(vectors, "CELLS", 1000)
    assert set(knn(docs, field="v", k=3, queries=queries).collect()) == whole
    assert len(whole) == 600


def test_a_grid_of_many_cells_gives_the_same_rows(spark, clustered, monkeypatch):
    docs = frame(spark, np.vstack([clustered[:200], clustered[:40]])).repartition(5)
    rows = [(i, clustered[i % 300].tolist()) for i in range(150)] + [(900, [0.0] * 16), (901, None), (902, [1.0]), (None, clustered[3].tolist())]
    queries = spark.createDataFrame(rows, "query_id long, vector array<double>")
    for search in (lambda join: knn(docs, field="v", k=7, queries=queries, join=join), lambda join: vector_range(docs, field="v", threshold=0.3, queries=queries, join=join)):
        whole = sorted(search("broadcast").collect(), key=str)
        assert whole and {r["query_id"] for r in whole} >= {0, None}
        for block in (vectors.QUERY_BLOCK_BYTES, 5000, 700):
            monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", block)
            assert sorted(search("grid").collect(), key=str) == whole
            monkeypatch.undo()


def test_a_grid_reads_both_tables_once_and_no_query_on_the_driver(spark, clustered, monkeypatch):
    docs = frame(spark, clustered[:100])
    queries = docs.select(F.col("_key").alias("query_id"), F.col("v").alias("vector"))
    monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", 500)
    monkeypatch.setattr(type(docs), "toArrow", lambda self: pytest.fail("queries reached the driver"))
    found = knn(docs, field="v", k=3, queries=queries)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    assert found.count() == 300


def test_many_equal_vectors_fall_back_to_the_key(spark):
    x = np.vstack([np.tile([1.0, 2.0], (500, 1)), [[2.0, 1.0]]])
    docs = frame(spark, x).repartition(7)
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, vector array<double>")
    assert sorted(r["_key"] for r in knn(docs, field="v", k=5, queries=queries).collect()) == [0, 1, 2, 3, 4]
    assert [r["_key"] for r in knn(docs, [1.0, 2.0], "v", k=5).collect()] == [0, 1, 2, 3, 4]


def test_unusable_queries_find_nothing(spark, clustered):
    docs = frame(spark, clustered[:50])
    rows = [(1, [0.0] * 16), (2, None), (3, [1.0]), (4, clustered[0].tolist())]
    queries = spark.createDataFrame(rows, "query_id long, vector array<double>")
    assert {r["query_id"] for r in knn(docs, field="v", k=2, queries=queries).collect()} == {4}


def test_unusable_vectors_are_never_returned(spark):
    rows = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", None), ("c", [1.0]), ("d", [float("nan"), 1.0]), ("e", [None, 1.0]), ("z", [0.0, 0.0])],
        "_key string, v array<double>",
    )
    assert [r["_key"] for r in knn(rows, [1.0, 0.0], "v").collect()] == ["a"]
    assert {r["_key"] for r in knn(rows, [1.0, 0.0], "v", metric="L2").collect()} == {"a", "z"}


def test_normalisation_points(spark):
    values = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (9.0,), (99.0,)], "d double")
    got = {m: [r[0] for r in values.select(normalized(F.col("d"), m)).collect()] for m in ("COSINE", "L2", "IP")}
    assert got["COSINE"] == [1.0, 0.5, 0.0, 0.0, 0.0]
    assert got["L2"] == pytest.approx([1.0, 0.5, 1 / 3, 0.1, 0.01])
    assert got["IP"] == [0.0, 1.0, 2.0, 9.0, 99.0]
    assert [r[0] for r in values.limit(2).select(denormalized_cosine(F.col("d"))).collect()] == [2.0, 0.0]


def test_argument_errors(products):
    for bad in (
        dict(vector=[], field="embedding"),
        dict(vector=ONE, field=""),
        dict(vector=ONE, field="embedding", k=0),
        dict(vector=ONE, field="embedding", offset=-1),
        dict(vector=ONE, field="embedding", metric="HAMMING"),
        dict(vector=[float("nan")], field="embedding"),
    ):
        with pytest.raises(ValueError):
            knn(products, **bad)
    with pytest.raises(QueryError):
        vector_range(products, ONE, "embedding", threshold=-0.1)


def test_inverted_file_recall_and_policies(spark, clustered, tmp_path):
    docs = frame(spark, clustered, np.arange(len(clustered)) % 3)
    index = IvfIndex.build(docs, "v", str(tmp_path / "ivf"), 32, metric="L2")
    queries = docs.where("_key % 100 = 0").select(F.col("_key").alias("query_id"), F.col("v").alias("vector"))
    exact = {(r["query_id"], r["_key"]) for r in knn(docs, field="v", metric="L2", queries=queries).collect()}
    recall = {}
    for nprobe in (2, 32):
        found = {(r["query_id"], r["_key"]) for r in index.search(queries=queries, nprobe=nprobe).collect()}
        recall[nprobe] = len(found & exact) / len(exact)
    assert recall[2] >= 0.85 and recall[32] == 1.0
    q = clustered[0].tolist()
    want = [r["_key"] for r in knn(docs, q, "v", where=Num("label").eq(1), metric="L2").collect()]
    assert [r["_key"] for r in index.search(q, where=Num("label").eq(1), policy="ADHOC_BF").collect()] == want
    batches = index.search(q, k=400, where=Num("label").eq(1), policy="BATCHES", batch_size=1)
    assert batches.count() == 400 and batches.where("label != 1").count() == 0
    reopened = IvfIndex.open(spark, str(tmp_path / "ivf"), "v", "L2")
    assert reopened.nlist == 32
    for bad in (dict(policy="GUESS"), dict(batch_size=2), dict(policy="BATCHES", batch_size=0), dict(nprobe=0)):
        with pytest.raises(QueryError):
            index.search(q, **bad)


def test_inverted_file_prunes_partitions(spark, clustered, tmp_path):
    index = IvfIndex.build(frame(spark, clustered), "v", str(tmp_path / "ivf"), 8, metric="L2")
    plan = index.search(clustered[0].tolist(), nprobe=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(list_id" in plan


@pytest.mark.parametrize("metric", ["COSINE", "L2"])
def test_hash_bands_recall(spark, clustered, tmp_path, metric):
    docs = frame(spark, clustered)
    bands = Bands(24, 6, metric, 6.0)
    index = LshIndex.build(docs, "v", str(tmp_path / "lsh"), bands)
    hits = total = 0
    for i in range(0, 3000, 500):
        exact = {r["_key"] for r in knn(docs, clustered[i], "v", metric=metric).collect()}
        found = index.search(clustered[i].tolist(), fields=["label"])
        assert found.columns == ["_key", "label", "vector_distance"]
        hits += len(exact & {r["_key"] for r in found.collect()})
        total += len(exact)
    assert hits / total >= 0.9
    only = index.search(clustered[0].tolist(), where=Num("_key").lt(1500), fields=[])
    assert max(r["_key"] for r in only.collect()) < 1500


def test_similarity_join_finds_planted_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 24))
    near = base[:60] + rng.normal(size=(60, 24)) * 0.05
    x = np.vstack([base, near])
    docs = frame(spark, x)
    want = {
        (i, j) for i in range(len(x)) for j in np.flatnonzero(brute(x, x[i], "COSINE") <= 0.1) if i < j
    }
    exact = similarity_join(docs, field="v", threshold=0.1, method="exact")
    assert {(r["left_key"], r["right_key"]) for r in exact.collect()} == want
    rows = similarity_join(docs, field="v", threshold=0.1).collect()
    found = [(r["left_key"], r["right_key"]) for r in rows]
    assert len(found) == len(set(found)) and set(found) <= want and len(found) >= 0.95 * len(want)
    # The same pairs whatever the chunk size, so hot buckets may be split freely.
    chunked = similarity_join(docs, field="v", threshold=0.1, chunk=3).collect()
    assert sorted((r["left_key"], r["right_key"]) for r in chunked) == sorted(found)


def test_a_third_of_equal_vectors_gives_linear_pairs(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(size=(200, 8)), np.tile(rng.normal(size=(1, 8)), (100, 1))])
    docs = frame(spark, x)
    for method in ("lsh", "exact"):
        copies = similarity_join(docs, field="v", threshold=0.0, method=method).collect()
        assert {(r["left_key"], r["right_key"]) for r in copies} == {(200, j) for j in range(201, 300)}


def test_join_of_two_tables(spark):
    rng = np.random.default_rng(7)
    right = rng.normal(size=(150, 12))
    left = right[:30] + rng.normal(size=(30, 12)) * 0.02
    a, b = frame(spark, left), frame(spark, right)
    want = {(i, j) for i in range(30) for j in np.flatnonzero(brute(right, left[i], "L2") <= 0.5)}
    for method in ("lsh", "exact"):
        got = {(r["left_key"], r["right_key"]) for r in
               similarity_join(a, b, "v", 0.5, method, "L2", chunk=4).collect()}
        assert got <= want and len(got) >= 0.95 * len(want)


def test_schema_metric_outranks_the_given_one(products, product_schema):
    found = knn(products, ONE, "embedding", metric="L2", schema=product_schema, k=2).collect()
    assert found[1]["vector_distance"] < 0.1
    assert DocumentSchema("x").field("embedding") is None


def test_batch_knn_trims_before_the_shuffle(spark, clustered):
    docs = frame(spark, clustered[:100])
    queries = docs.select(F.col("_key").alias("query_id"), F.col("v").alias("vector"))
    plan = knn(docs, field="v", queries=queries)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert "Partial" in plan


def test_a_vector_crosses_to_python_once(products, product_schema):
    for found in (
        knn(products, [1.0, 0.0, 0.0, 0.0], "embedding", k=2, schema=product_schema),
        vector_range(products, [1.0, 0.0, 0.0, 0.0], "embedding", threshold=0.5, schema=product_schema),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


def test_vectors_of_another_length_do_not_empty_an_index(spark, tmp_path):
    rows = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(20)] + [(i, [1.0, 1.0, 1.0]) for i in (20, 21)], "_key long, v array<double>")
    index = IvfIndex.build(rows, "v", f"file://{tmp_path}/ivf", 1)
    assert index.table.count() == 20 and index.search([1.0, 1.0], k=1, nprobe=1).first()["_key"] == 0


def test_similarity_join_keeps_copies_and_lengths(spark):
    rows = [(1, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, 0.0, 0.0]), (6, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "_key long, v array<double>")
    for method in ("exact", "lsh"):
        own = {(r["left_key"], r["right_key"]) for r in similarity_join(table, field="v", threshold=0.1, method=method).collect()}
        assert own == {(1, 10), (1, 11), (5, 6)}
        two = similarity_join(table.where("_key = 1"), table.where("_key >= 10"), "v", 0.1, method)
        assert {(r["left_key"], r["right_key"], r["distance"]) for r in two.collect()} == {(1, 10, 0.0), (1, 11, 0.0)}


def test_calibrated_lists_reach_the_recall(spark, clustered, tmp_path):
    docs = frame(spark, clustered[:300])
    index = IvfIndex.build(docs, "v", f"{tmp_path}/ivf", 8, dims=16)
    queries = docs.select(F.col("_key").alias("query_id"), F.col("v").alias("vector"))
    few, all_lists = index.calibrate(queries, 5, 0.5), index.calibrate(queries, 5, 1.0)
    assert 1 <= few <= all_lists <= 8
    exact = {(r["query_id"], r["_key"]) for r in knn(docs, field="v", k=5, queries=queries).collect()}
    for nprobe, least in ((few, 0.5), (all_lists, 1.0)):
        found = {(r["query_id"], r["_key"]) for r in index.search(queries=queries, k=5, nprobe=nprobe, fields=[]).collect()}
        assert len(found & exact) >= least * len(exact)


def test_a_grid_has_no_more_rows_than_keep_the_cores_busy(spark, monkeypatch):
    docs = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)], "_key long, v array<float>")
    queries = docs.select(F.col("_key").alias("query_id"), F.col("v").alias("vector"))
    options = dict(field="v", k=4, queries=queries)
    expected = sorted(tuple(r) for r in knn(docs, join="broadcast", **options).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        cells = vectors.CELLS_PER_CORE * spark.sparkContext.defaultParallelism
        pieces = vectors._grid(docs.select(F.col("_key").alias("key"), F.col("v").alias("vector")), queries.withColumnRenamed("query_id", "id"), 2)
        copies = pieces.where("not document").count() / 60
        assert copies == -(-cells // 2) and pieces.where("document").count() == 2 * 60
        assert sorted(tuple(r) for r in knn(docs, join="grid", **options).collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hashes_of_many_rows_are_those_of_each_alone(monkeypatch):
    from lakesearch.functions import hashing

    x = np.random.default_rng(3).standard_normal((50, 8))
    for bands in (hashing.Bands(5, 6), hashing.Bands(5, 6, "L2", 0.5)):
        whole = bands.hashes(x)
        monkeypatch.setattr(hashing, "_PROJECTIONS", 100)
        assert (bands.hashes(x) == whole).all() and whole.shape == (50, 5)
        assert (bands.hashes(x[:0])).shape == (0, 5)
        monkeypatch.undo()


def _pairs_of(rows, threshold, metric="COSINE"):
    """All pairs of ``(key, vector)`` rows within ``threshold`` whose left key is the smaller one, as often as they occur."""
    x = np.array([v for _, v in rows])
    near = [np.flatnonzero(brute(x, v, metric) <= threshold) for v in x]
    return Counter((rows[i][0], rows[j][0]) for i in range(len(rows)) for j in near[i] if rows[i][0] < rows[j][0])


def test_every_pair_of_copies_and_repeated_keys_is_joined(spark):
    rng = np.random.default_rng(21)
    base = rng.normal(size=(40, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, base[i % 3].tolist()) for i in range(12)]
    rows += [(5, base[5].tolist()), (5, base[6].tolist()), (103, base[0].tolist())]
    table = spark.createDataFrame([*rows, (None, base[0].tolist())], "_key long, v array<double>")
    for metric, threshold in (("COSINE", 0.4), ("L2", 1.5)):
        want = _pairs_of(rows, threshold, metric)
        found = similarity_join(table, field="v", threshold=threshold, method="exact", metric=metric, every=True).collect()
        assert Counter((r["left_key"], r["right_key"]) for r in found) == want
    found = similarity_join(table, field="v", threshold=0.4, every=True).collect()
    found, want = Counter((r["left_key"], r["right_key"]) for r in found), _pairs_of(rows, 0.4)
    assert not found - want and found[(100, 103)] == 2 and found.total() >= 0.9 * want.total()


def test_the_join_report_has_the_pairs_of_its_sql_among_copies(spark, tmp_path):
    rng = np.random.default_rng(22)
    x = rng.normal(size=(5, 64)).astype(np.float32)
    rows = [(i, x[i % 5].tolist(), i % 10) for i in range(15)] + [(3, x[3].tolist(), 3)]
    spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = REPORTS["V8_similarity_join_exact"].run(spark, str(tmp_path)).collect()
    want = Counter((a, b) for a, u, _ in rows for b, v, _ in rows if a < b and u == v)
    assert Counter((r["left_key"], r["right_key"]) for r in found) == want and {r["distance"] for r in found} == {0.0}


def test_a_join_of_two_tables_has_rows_of_a_repeated_key(spark):
    right = [(1, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [0.9, 0.1])]
    a = spark.createDataFrame([(2, [1.0, 0.0])], "_key long, v array<double>")
    b = spark.createDataFrame(right, "_key long, v array<double>")
    for method in ("exact", "lsh"):
        found = Counter((r["left_key"], r["right_key"]) for r in similarity_join(a, b, "v", 0.1, method).collect())
        assert found == {(2, 1): 1, (2, 7): 3}


def test_blocks_of_a_self_join_hold_a_bounded_size_and_meet_once(spark, monkeypatch):
    rng = np.random.default_rng(23)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 5)))]
    table = spark.createDataFrame(rows, "_key long, v array<double>")
    monkeypatch.setattr(similarity, "HELD_BYTES", 1400)
    dealt = []
    deal = type(table).repartitionById
    monkeypatch.setattr(type(table), "repartitionById", lambda df, n, c: dealt.append((n, df.count())) or deal(df, n, c))
    found = similarity_join(table, field="v", threshold=0.3, method="exact")
    # 7 blocks, each with itself and the 6 others.
    assert dealt == [(28, 7 * 90)]
    assert Counter((r["left_key"], r["right_key"]) for r in found.collect()) == _pairs_of(rows, 0.3)


def test_unselective_bands_find_what_their_buckets_would(spark, tmp_path):
    bands = Bands.for_cosine(0.6)
    assert similarity._meet_anyway(bands) and not similarity._meet_anyway(Bands.for_cosine(0.1))
    rng = np.random.default_rng(24)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 8)))], "_k long, _v array<double>")
    met = similarity._all_with_all(rows, 8, 0.6, "COSINE", bands)
    buckets = similarity._banded(rows, rows, 8, 0.6, "COSINE", bands, 50, True)
    found = sorted(tuple(r) for r in met.collect())
    assert found == sorted(tuple(r) for r in buckets.collect()) and len(found) > 300
    # No bucket rows, so no copy of a vector for each of the bands.
    table = rows.toDF("_key", "v")
    plan = similarity_join(table, field="v", threshold=0.6)._jdf.queryExecution().optimizedPlan().toString()
    assert "_signature" not in plan


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e120])
@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_near_pairs_are_those_of_the_distances(metric, scale):
    rng = np.random.default_rng(25)
    x, q = rng.normal(size=(300, 7)), rng.normal(size=(250, 7))
    q[:50], x[7], q[60] = x[:50] * 3.0, 0.0, 0.0
    if metric == "COSINE":
        x, q = x * scale, q * scale
    a, b = distance.Vectors(x, metric), distance.Vectors(q, metric)
    for limit in (-1.0, 0.0, 0.02, 0.6, 1.9, np.inf):
        i, j = np.nonzero(distance.raw_distances(x, q, metric) <= limit + distance.MARGIN)
        found = [t[:2] for t in distance.near_pairs(a, np.arange(300), b, np.arange(250), lambda _: limit)]
        got = {(r, c) for rows, columns in found for r, c in zip(rows, columns)}
        assert got == set(zip(i, j)) and sum(len(rows) for rows, _ in found) == len(got)


def test_the_norm_of_a_training_vector_is_computed_once(spark):
    docs = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "_key long, v array<float>")
    rows = ann._units(docs, F.col("v"), "COSINE")
    assert [r[0] for r in rows.collect()] == [[0.6, 0.8], [0.0, 0.0]]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    turned = next(line for line in plan.splitlines() if "transform(" in line)
    assert "aggregate(" not in turned
