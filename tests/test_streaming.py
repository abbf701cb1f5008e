import pytest
from pyspark.sql import functions as F

from lakesearch.errors import QueryError

from lakesearch.functions.predicates import Num, Tag
from lakesearch.plans.streams import drained, stream_of
from lakesearch.schema import DocumentSchema
from lakesearch.sources.collection import Collection
from lakesearch.sources.load import load
from lakesearch.streaming.ingest import match_queries, standing_match, standing_queries, stream_load

SCHEMA = DocumentSchema("s", [{"name": "n", "type": "numeric"}, {"name": "g", "type": "geo"}], prefix="k")


def batches(spark, tmp_path):
    """Three files, read one per micro-batch."""
    data = [[("a", 1, "0,0"), ("b", 1, "0,0")], [("a", 2, "0,0"), ("c", 2, "bad")], [("b", 3, "1,1"), ("d", 3, "2,2")]]
    for i, rows in enumerate(data):
        spark.createDataFrame(rows, "id string, n int, g string").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("id string, n int, g string").option("maxFilesPerTrigger", 1)
    return stream.option("latestFirst", "false").parquet(f"{tmp_path}/in/*"), [r for b in data for r in b]


def test_stream_equals_batch_and_replays_change_nothing(spark, tmp_path):
    stream, rows = batches(spark, tmp_path)
    target = Collection(spark, f"{tmp_path}/stream", SCHEMA)
    options = dict(id_field="id", order="n", validate="quarantine")
    query = stream_load(stream, target, f"{tmp_path}/cp", quarantine=f"{tmp_path}/bad", available_now=True, **options)
    query.awaitTermination()
    whole = Collection(spark, f"{tmp_path}/batch", SCHEMA)
    load(spark.createDataFrame(rows, "id string, n int, g string"), whole, **options)
    got = sorted(tuple(r) for r in target.read().select("_key", "n", "g").collect())
    assert got == sorted(tuple(r) for r in whole.read().select("_key", "n", "g").collect())
    assert got == [("k:a", 2, "0,0"), ("k:b", 3, "1,1"), ("k:d", 3, "2,2")]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == ["c"]
    before = target.appended().count()
    # A fresh checkpoint sends every batch again under the same numbers.
    stream_load(stream, target, f"{tmp_path}/cp2", available_now=True, **options).awaitTermination()
    assert target.appended().count() == before
    assert sorted(tuple(r) for r in target.read().select("_key", "n", "g").collect()) == got


def test_stream_rows_expire(spark, tmp_path):
    stream, _ = batches(spark, tmp_path)
    target = Collection(spark, f"{tmp_path}/stream", SCHEMA)
    stream_load(stream, target, f"{tmp_path}/cp", id_field="id", ttl=3600, available_now=True).awaitTermination()
    assert target.read().count() == 4
    assert target.read(F.current_timestamp() + F.expr("INTERVAL 2 HOURS")).count() == 0


def test_standing_match_is_the_batch_answer(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x" if i % 2 else "y", [float(i), 1.0]) for i in range(20)], "_key int, t string, v array<double>")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    options = dict(where=Tag("t").eq("x") & Num("_key").gt(2), vector=[8.0, 1.0], field="v", threshold=3.0, metric="L2")
    match = standing_match(stream, **options)
    query = match.writeStream.format("memory").queryName("standing").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["_key"] for r in spark.table("standing").collect()) == [5, 7, 9, 11]
    assert sorted(r["_key"] for r in standing_match(rows, **options).collect()) == [5, 7, 9, 11]
    assert standing_match(rows, Num("_key").lt(3)).count() == 3


QUERY = "query_id int, vector array<double>, threshold double"
CONDITION = "query_id int, field string, op string, text string, number double"


def test_queries_are_read_anew_by_every_micro_batch(spark, tmp_path):
    points = [[("a", "x", 1.0, [0.0, 1.0]), ("b", "y", 2.0, [0.0, 3.0])], [("c", "x", None, [0.0, 1.5]), ("d", "y", 4.0, None)]]
    schema = "_key string, tag string, n double, v array<double>"
    for i, rows in enumerate(points):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    queries = [(1, [0.0, 1.0], 0.6), (2, [0.0, 1.0], 5.0), (3, None, 5.0)]
    conditions = [(1, "tag", "eq", "x", None), (2, "n", "ge", None, 2.0), (2, "tag", "ne", "x", None)]
    calls = []

    def read(session):
        calls.append(1)
        more = [(4, [0.0, 1.5], 0.0)] if len(calls) > 1 else []
        return session.createDataFrame(queries + more, QUERY), session.createDataFrame(conditions, CONDITION)

    query = standing_queries(stream, read, "v", f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True, metric="L2")
    query.awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    assert {(r["query_id"], r["_key"]) for r in found} == {(1, "a"), (2, "b"), (1, "c"), (4, "c")} and len(calls) == 2


def test_a_missing_value_meets_no_condition_and_an_unknown_field_is_an_error(spark):
    rows = spark.createDataFrame([("a", None, [1.0, 0.0]), ("b", 1.0, [1.0, 0.0])], "_key string, n double, v array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0], 0.1)], QUERY)
    only = lambda *c: match_queries(rows, queries, "v", spark.createDataFrame([c], CONDITION))
    assert [r["_key"] for r in only(1, "n", "ne", None, 5.0).collect()] == ["b"]
    assert match_queries(rows, queries, "v").count() == 2 and match_queries(rows, queries.where("false"), "v").count() == 0
    with pytest.raises(QueryError):
        only(1, "nope", "eq", "x", None)


def test_a_table_is_streamed_whole_as_a_file_a_folder_and_by_partition(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x" if i % 2 else "y") for i in range(20)], "n int, t string")
    rows.repartition(3).write.parquet(f"{tmp_path}/parts/given.parquet")
    rows.write.partitionBy("t").parquet(f"{tmp_path}/by/given.parquet")
    (tmp_path / "one").mkdir()
    rows.toPandas().to_parquet(f"{tmp_path}/one/given.parquet", index=False)
    for kind in ("parts", "by", "one"):
        found = drained(stream_of(spark, f"{tmp_path}/{kind}", "given"))
        assert sorted((r["n"], r["t"]) for r in found.collect()) == sorted(tuple(r) for r in rows.collect()), kind
