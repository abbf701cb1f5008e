import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesearch.errors import QueryError, SchemaError
from lakesearch.functions.codec import decode_error, decoded, encode_error, encoded
from lakesearch.functions.validation import errors_column
from lakesearch.operators.embedding import HashingVectorizer, ModelVectorizer, embed
from lakesearch.operators.profile import profile
from lakesearch.operators.vectors import knn
from lakesearch.schema import DocumentSchema
from lakesearch.sources.collection import Collection, union_collections
from lakesearch.sources.load import load, split_valid, with_keys

FIELDS = [
    {"name": "name", "type": "text"},
    {"name": "tag", "type": "tag"},
    {"name": "price", "type": "numeric"},
    {"name": "place", "type": "geo"},
    {"name": "v", "type": "vector", "attrs": {"algorithm": "flat", "dims": 2}},
]


def schema_of(storage="hash", prefix="doc"):
    return DocumentSchema("docs", FIELDS, prefix=prefix, storage=storage)


def docs(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, price double, extra int")


def stored(target, *columns):
    return sorted(tuple(r) for r in target.read().select("_key", *columns).collect())


@pytest.fixture
def target(spark, tmp_path):
    return Collection(spark, str(tmp_path / "c"), schema_of())


def test_keys(spark):
    rows = docs(spark, [("1", "a", 1.0, 1)])
    assert with_keys(rows, schema_of(prefix="doc:::"), "id").first()["_key"] == "doc:1"
    assert with_keys(rows, schema_of(prefix=""), "id").first()["_key"] == "1"
    assert with_keys(rows, schema_of(prefix=["p", "q"]), "id").first()["_key"] == "p:1"
    assert with_keys(rows, schema_of(), keys="name").first()["_key"] == "a"
    assert with_keys(rows.union(rows), schema_of()).select("_key").distinct().count() == 2
    for bad in (dict(id_field="nope"), dict(keys="nope")):
        with pytest.raises(SchemaError):
            with_keys(rows, schema_of(), **bad)


def test_merge_keeps_and_replace_drops_old_fields(spark, tmp_path):
    old = [("1", "a", 1.0, 1), ("2", "b", 2.0, 2)]
    new = [("2", None, 22.0, None), ("3", "c", None, 3)]
    merged = Collection(spark, str(tmp_path / "h"), schema_of("hash"))
    replaced = Collection(spark, str(tmp_path / "j"), schema_of("json"))
    for c in (merged, replaced):
        load(docs(spark, old), c, id_field="id")
        result = load(docs(spark, new), c, id_field="id")
        assert result.batch[0] == "load" and sorted(r[0] for r in result.keys.collect()) == ["doc:2", "doc:3"]
    assert stored(merged, "name", "price", "extra") == [("doc:1", "a", 1.0, 1), ("doc:2", "b", 22.0, 2), ("doc:3", "c", None, 3)]
    assert stored(replaced, "name", "price", "extra") == [("doc:1", "a", 1.0, 1), ("doc:2", None, 22.0, None), ("doc:3", "c", None, 3)]


def test_the_last_of_repeated_keys_wins(spark, target):
    rows = docs(spark, [("1", "first", 1.0, 5), ("1", "second", None, 9), ("1", None, 3.0, 7)])
    load(rows, target, id_field="id", order="extra")
    assert stored(target, "name", "price", "extra") == [("doc:1", "second", 3.0, 9)]
    load(docs(spark, [("1", "x", 1.0, 1), ("1", "y", 2.0, 2)]), target, id_field="id", mode="replace", order="extra")
    assert stored(target, "name", "price") == [("doc:1", "y", 2.0)]


def test_new_columns_may_appear_later(spark, target):
    load(docs(spark, [("1", "a", 1.0, 1)]), target, id_field="id")
    load(docs(spark, [("2", "b", 2.0, 2)]).withColumn("color", F.lit("red")), target, id_field="id")
    load(docs(spark, [("3", "c", 3.0, 3)]), target, id_field="id")
    assert stored(target, "name", "color") == [("doc:1", "a", None), ("doc:2", "b", "red"), ("doc:3", "c", None)]


def files(target):
    """The stored files of every batch."""
    return {r[0] for r in target.appended().select(F.input_file_name()).distinct().collect()}


def test_a_load_writes_its_own_rows_only(spark, target):
    load(docs(spark, [(str(i), "a", 1.0, 1) for i in range(40)]), target, id_field="id")
    before = files(target)
    load(docs(spark, [("1", "b", 1.0, 1)]), target, id_field="id")
    assert files(target) > before and target.appended().count() == 41
    assert target.read().where("name = 'b'").count() == 1 and target.read().count() == 40


def test_a_repeated_batch_overwrites_its_first_try(spark, target):
    load(docs(spark, [("1", "a", 1.0, 1), ("2", "half", 1.0, 1)]), target, id_field="id", batch=("s", 0))
    load(docs(spark, [("1", "later", None, 1)]), target, id_field="id", batch=("t", 0))
    load(docs(spark, [("1", "again", 2.0, 1), ("3", "c", 1.0, 1)]), target, id_field="id", batch=("s", 0))
    # The repeat counts as arrived with the first try, so the other source's row is still the last.
    assert stored(target, "name", "price") == [("doc:1", "later", 2.0), ("doc:3", "c", 1.0)]


def test_repeated_keys_need_an_order(spark, target):
    same = docs(spark, [("1", "a", 1.0, 1), ("1", "a", 1.0, 1)])
    load(same, target, id_field="id")
    assert stored(target, "name") == [("doc:1", "a")]
    with pytest.raises(Exception, match="no column orders them"):
        load(same.union(docs(spark, [("1", "b", 1.0, 1)])), target, id_field="id")
    assert stored(target, "name") == [("doc:1", "a")]


def test_purge_rewrites_only_batches_with_expired_keys(spark, target):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    load(docs(spark, [("1", "a", 1.0, 1), ("2", "b", 1.0, 1)]), target, id_field="id")
    load(docs(spark, [("3", "c", 1.0, 1)]), target, id_field="id", ttl=5, now=now)
    load(docs(spark, [("4", "d", 1.0, 1)]), target, id_field="id", ttl=5, now=now)
    load(docs(spark, [("4", None, 9.0, 1)]), target, id_field="id", ttl=10**6, now=now)
    before = files(target)
    target.purge(F.lit("2024-01-02").cast("timestamp"))
    assert len(files(target) & before) == 3
    assert [r["_key"] for r in target.read(F.lit("2024-01-02").cast("timestamp"), expired=True).orderBy("_key").collect()] == ["doc:1", "doc:2", "doc:4"]
    # When the later row of this key arrived, the first had expired.
    assert target.raw().where("_key = 'doc:4'").select("name", "price").first() == (None, 9.0)


def test_a_later_row_lends_its_life_to_the_whole_key(spark, target):
    load(docs(spark, [("1", "a", 1.0, 1)]), target, id_field="id", ttl=10**6)
    load(docs(spark, [("1", None, 2.0, 1)]), target, id_field="id", ttl=10**9)
    later = F.current_timestamp() + F.expr("INTERVAL 100 DAYS")
    assert [(r["name"], r["price"]) for r in target.read(later).collect()] == [("a", 2.0)]


def test_expiry(spark, target):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    load(docs(spark, [("1", "a", 1.0, 1)]), target, id_field="id", ttl=30, now=now)
    load(docs(spark, [("2", "b", 2.0, 2)]), target, id_field="id", ttl=0)

    def alive(text):
        return [r["_key"] for r in target.read(F.lit(text).cast("timestamp")).orderBy("_key").collect()]

    assert alive("2024-01-01 00:00:29") == ["doc:1", "doc:2"] and alive("2024-01-01 00:00:30") == ["doc:2"]
    assert target.read(expired=True).count() == 2
    target.purge(F.lit("2024-01-02").cast("timestamp"))
    assert target.read(expired=True).count() == 1
    # An expired row counts as absent, so merging does not bring its fields back.
    load(docs(spark, [("3", "old", 1.0, 1)]), target, id_field="id", ttl=1, now=now)
    load(docs(spark, [("3", None, 3.0, None)]), target, id_field="id")
    assert stored(target, "name", "price") == [("doc:2", "b", 2.0), ("doc:3", None, 3.0)]
    with pytest.raises(QueryError):
        load(docs(spark, []), target, id_field="id", ttl=-1)


def test_fetch_keeps_order_and_gaps(spark, target):
    load(docs(spark, [(str(i), f"n{i}", 1.0, i) for i in range(20)]), target, id_field="id")
    got = target.fetch_many(["7", "nope", "3", "7"]).collect()
    assert [(r["_key"], r["name"], r["_found"]) for r in got] == [
        ("doc:7", "n7", True), ("doc:nope", None, False), ("doc:3", "n3", True), ("doc:7", "n7", True)]
    assert target.fetch("5").first()["extra"] == 5


def test_validation_modes(spark, target):
    rows = spark.createDataFrame(
        [("1", "a", "0,0", [1.0, 2.0]), ("2", "b", "181,0", [1.0, 2.0]), ("3", "c", "-180,-90", [1.0]), ("4", None, None, None),
         ("5", "e", "1;2", [None, 1.0]), ("6", "f", "x,1", [1.0, 1.0]), ("7", "g", "180,90.1", [1.0, 1.0])],
        "id string, name string, place string, v array<double>",
    )
    bad = {r["id"]: r["e"] for r in rows.select("id", errors_column(rows, schema_of()).alias("e")).collect() if r["e"]}
    assert set(bad) == {"2", "3", "5", "6", "7"} and len(bad["5"]) == 2
    assert "longitude must be" in bad["2"][0] and "Expected 2 but got 1" in bad["3"][0] and "invalid coordinates" in bad["6"][0]
    with pytest.raises(SchemaError, match="doc:"):
        load(rows, target, id_field="id", validate="fail")
    assert target.read().count() == 0
    result = load(rows, target, id_field="id", validate="quarantine")
    assert sorted(r[0] for r in target.read().select("_key").collect()) == ["doc:1", "doc:4"]
    assert result.rejected.count() == 5
    load(rows, target, id_field="id")
    assert target.read().count() == 7


def test_types_are_validated(spark):
    rows = spark.createDataFrame([("a", "12", 3, b"\0" * 8, [1])], "_key string, price string, name int, v binary, tag array<int>")
    errors = rows.select(errors_column(rows, schema_of())).first()[0]
    assert len(errors) == 3 and any("price" in e for e in errors) and any("name" in e for e in errors) and any("tag" in e for e in errors)
    valid, wrong = split_valid(rows, schema_of())
    assert valid.count() == 0 and wrong.count() == 1


def test_preprocess_runs_before_validation(spark, target):
    rows = docs(spark, [("1", "a", 1.0, 1)]).withColumn("place", F.lit("bad"))
    load(rows, target, id_field="id", preprocess=lambda d: d.withColumn("place", F.lit("1,2")), validate="fail")
    assert stored(target, "place") == [("doc:1", "1,2")]


def test_collections_of_several_prefixes(spark, tmp_path):
    a, b = (Collection(spark, str(tmp_path / p), schema_of(prefix=p)) for p in ("a", "b"))
    load(docs(spark, [("1", "x", 1.0, 1)]), a, id_field="id")
    load(docs(spark, [("1", "y", 1.0, 1)]).withColumn("more", F.lit(1)), b, id_field="id")
    both = union_collections([a, b]).orderBy("_key").collect()
    assert [(r["_key"], r["_prefix"], r["more"]) for r in both] == [("a:1", "a", None), ("b:1", "b", 1)]


SAMPLES = {
    "FLOAT32": ([-1.0 + i / 100 for i in range(384)], 6),
    "FLOAT64": ([-1.0 + i / 100 for i in range(384)], 12),
    "FLOAT16": ([-2, -1, -0.5, -0.25, 0, 0.25, 0.5, 1], 2),
    "BFLOAT16": ([-2, -1, -0.5, -0.25, 0, 0.25, 0.5, 1], 1),
    "INT8": ([-128, -1, 0, 127], 0),
    "UINT8": ([0, 1, 128, 255], 0),
}
SIZES = {"FLOAT32": 4, "FLOAT64": 8, "FLOAT16": 2, "BFLOAT16": 2, "INT8": 1, "UINT8": 1}


@pytest.mark.parametrize("datatype", list(SAMPLES))
def test_vectors_survive_encoding(spark, datatype):
    values, decimals = SAMPLES[datatype]
    rows = spark.createDataFrame([(0, [float(v) for v in values]), (1, []), (2, None), (3, [float(v) for v in values[:3]])], "i int, v array<double>")
    rows = rows.repartition(2).withColumn("b", encoded(F.col("v"), datatype)).withColumn("d", decoded(F.col("b"), datatype))
    got = {r["i"]: r for r in rows.collect()}
    assert got[2]["b"] is None and got[2]["d"] is None and got[1]["d"] == [] and len(got[3]["b"]) == 3 * SIZES[datatype]
    assert len(got[0]["b"]) == len(values) * SIZES[datatype]
    np.testing.assert_array_almost_equal(np.array(got[0]["d"], dtype=float), values, decimals)


def test_encoded_bits(spark):
    def bits(value, datatype):
        return spark.createDataFrame([([value],)], "v array<double>").select(encoded(F.col("v"), datatype)).first()[0].hex()

    assert bits(1.0, "FLOAT32") == "0000803f" and bits(1.0, "FLOAT64") == "000000000000f03f"
    assert bits(65504.0, "FLOAT16") == "ff7b" and bits(65520.0, "FLOAT16") == "007c" and bits(2.0**-24, "FLOAT16") == "0100"
    # Halves round to even: 1 + 2^-8 lies between 1 and 1 + 2^-7.
    assert bits(1 + 2.0**-8, "BFLOAT16") == "803f" and bits(1 + 3 * 2.0**-8, "BFLOAT16") == "823f"
    assert bits(1 + 2.0**-11, "FLOAT16") == "003c" and bits(1 + 3 * 2.0**-11, "FLOAT16") == "023c"
    assert bits(-1.0, "INT8") == "ff" and bits(200.0, "UINT8") == "c8"


def test_encoding_errors(spark):
    rows = spark.createDataFrame([([1.0, float("nan")],), ([1.0, None],), ([1.5],), ([128.0],), ([-1.0],)], "v array<double>")
    for datatype, bad in (("FLOAT32", [1, 1, 0, 0, 0]), ("INT8", [1, 1, 1, 1, 0]), ("UINT8", [1, 1, 1, 0, 1])):
        got = rows.select(encode_error(F.col("v"), datatype).alias("e"), encoded(F.col("v"), datatype).alias("b")).collect()
        assert [int(r["e"] is not None) for r in got] == bad and [int(r["b"] is None) for r in got] == bad
    odd = spark.createDataFrame([(b"123",)], "b binary")
    row = odd.select(decode_error(F.col("b"), "FLOAT16").alias("e"), decoded(F.col("b"), "FLOAT16").alias("v")).first()
    assert "not a multiple" in row["e"] and row["v"] is None
    with pytest.raises(SchemaError):
        encoded(F.col("b"), "FLOAT8")


def test_profile_counts(spark):
    rows = spark.createDataFrame(
        [("a", "two words", "x", 1.0, [1.0, 2.0]), ("b", "", None, None, [1.0]), ("c", None, "y", 2.0, None)],
        "_key string, name string, tag string, price double, v array<double>",
    )
    got = {r["field"]: r for r in profile(rows, schema_of()).collect()}
    assert set(got) == {"name", "tag", "price", "v"}
    name, v = got["name"], got["v"]
    assert (name["rows"], name["present"], name["missing"], name["empty"], name["tokens"], name["mean_tokens"]) == (3, 2, 1, 1, 2, 1.0)
    assert (v["dims_min"], v["dims_max"], v["bad_dims"], v["missing"]) == (1, 2, 1, 1) and got["price"]["present"] == 2


def test_model_vectorizer_pools_and_normalises(spark):
    def build():
        return lambda texts: [np.array([[len(t), 0.0], [0.0, 3.0]]) for t in texts]

    rows = spark.createDataFrame([("1", "four"), ("2", None)], "_key string, t string")
    mean = {r["_key"]: r["e"] for r in embed(rows, "t", "e", ModelVectorizer("m", 2, build), 1).collect()}
    assert mean["1"] == pytest.approx([0.8, 0.6]) and mean["2"] is None
    cls = ModelVectorizer("m", 2, build, pooling="cls", normalize=False)
    assert cls.embed(spark, "four") == [4.0, 0.0] and cls.embed_many(spark, []) == [] and (cls.model, cls.dims) == ("m", 2)
    for bad in (dict(model=" "), dict(dims=0), dict(pooling="max")):
        with pytest.raises(QueryError):
            ModelVectorizer(**{"model": "m", "dims": 2, "build": build, **bad})


def test_hashing_vectorizer_feeds_load_and_search(spark, tmp_path):
    model = HashingVectorizer(64)
    schema = DocumentSchema("d", [{"name": "t", "type": "text"}, {"name": "e", "type": "vector", "attrs": {"algorithm": "flat", "dims": 64}}])
    target = Collection(spark, str(tmp_path / "c"), schema)
    rows = spark.createDataFrame([("1", "red apple pie"), ("2", "blue sky"), ("3", None)], "id string, t string")
    load(rows, target, id_field="id", preprocess=lambda d: embed(d, "t", "e", model), validate="fail")
    hits = knn(target.read(), model.embed(spark, "apple pie red"), "e", k=1, schema=schema).first()
    assert hits["_key"] == "doc:1" and hits["vector_distance"] == pytest.approx(0, abs=1e-6)
    assert model.embed_many(spark, ["a b", "c"])[1] == model.embed(spark, "c")
