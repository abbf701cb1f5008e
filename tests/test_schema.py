import pytest

from lakesearch.errors import QueryError, SchemaError
from lakesearch.functions.refs import expression_sql, reference_name
from lakesearch.schema import DocumentSchema, Field

VECTOR = {"name": "v", "type": "vector", "attrs": {"algorithm": "hnsw", "dims": 3, "distance_metric": "l2"}}


def test_fields_are_added_and_removed():
    schema = DocumentSchema("s", [{"name": "a", "type": "text"}])
    schema.add_fields([VECTOR, {"name": "t", "type": "tag"}]).remove_field("a").remove_field("unknown")
    assert schema.field_names == ["v", "t"]
    assert schema.fields["t"].attrs["separator"] == ","
    assert schema.fields["v"].metric == "L2" and schema.fields["v"].datatype == "FLOAT32"


@pytest.mark.parametrize(
    "spec",
    [
        {"name": "x", "type": "boolean"},
        {"name": "", "type": "text"},
        {"name": "x"},
        {"name": "x", "type": "vector"},
        {"name": "x", "type": "vector", "attrs": {"algorithm": "flat"}},
        {"name": "x", "type": "vector", "attrs": {"algorithm": "tree", "dims": 2}},
        {"name": "x", "type": "vector", "attrs": {"algorithm": "flat", "dims": 2, "datatype": "FLOAT8"}},
        {"name": "x", "type": "vector", "attrs": {"algorithm": "flat", "dims": 2, "metric": "HAMMING"}},
    ],
)
def test_bad_fields_are_rejected(spec):
    with pytest.raises(SchemaError):
        DocumentSchema("s", [spec])


def test_duplicate_names_and_empty_name_are_rejected():
    with pytest.raises(SchemaError):
        DocumentSchema("s", [{"name": "a", "type": "text"}, {"name": "a", "type": "tag"}])
    with pytest.raises(SchemaError):
        DocumentSchema("")
    with pytest.raises(SchemaError):
        DocumentSchema("s", storage="disk")


def test_plain_objects_round_trip_in_both_spellings():
    data = {
        "index": {"name": "s", "prefix": ["a", "b"], "keySeparator": "::", "storageType": "json", "stopwords": ["x"]},
        "fields": {"t": {"name": "t", "type": "tag", "attrs": {"caseSensitive": True}}, "v": VECTOR},
    }
    schema = DocumentSchema.from_dict(data)
    assert schema.fields["t"].attrs["case_sensitive"] is True
    assert schema.fields["v"].path == "$.v"
    again = DocumentSchema.from_dict(schema.to_dict())
    assert again.to_dict() == schema.to_dict()
    with pytest.raises(SchemaError):
        DocumentSchema.from_dict({"index": {"name": "s"}, "fields": {"a": {"name": "b", "type": "tag"}}})


def test_roles_survive_a_parquet_round_trip(spark, products, product_schema, tmp_path):
    product_schema.annotate(products).write.parquet(str(tmp_path / "p"))
    back = DocumentSchema.from_frame(spark.read.parquet(str(tmp_path / "p")), "products")
    assert {n: f.role for n, f in back.fields.items()} == {n: f.role for n, f in product_schema.fields.items()}
    assert back.fields["embedding"].dims == 4


def test_nested_paths_become_columns(spark):
    rows = spark.createDataFrame([("1", ("acme", 4.7), '{"k": {"n": 3}}')], "id string, meta struct<brand:string,rating:double>, raw string")
    schema = DocumentSchema(
        "n",
        [
            {"name": "$.meta.rating", "type": "numeric", "attrs": {"as": "rating"}},
            {"name": "brand", "type": "tag", "path": "$.meta.brand"},
            {"name": "n", "type": "numeric", "path": "$.raw.k.n"},
        ],
        storage="json",
    )
    row = schema.project(rows).first()
    assert (row["rating"], row["brand"], row["n"]) == (4.7, "acme", 3.0)


def test_references():
    assert [reference_name(r) for r in ("a", "@a", "$.x.a")] == ["a", "a", "a"]
    for bad in ("$a", "", "  "):
        with pytest.raises(QueryError):
            reference_name(bad)
    assert expression_sql("@a > 1 AND b = '@keep'") == "a > 1 AND b = '@keep'"


def test_field_types_map_to_spark():
    assert Field("x", "numeric").spark_type().simpleString() == "double"
    assert Field("x", "vector", {"algorithm": "flat", "dims": 2, "datatype": "int8"}).spark_type().simpleString() == "array<tinyint>"
