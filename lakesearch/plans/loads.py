"""Reports for loading, validating, fetching and profiling collections, and for embedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.codec import decoded, encoded
from ..functions.validation import errors_column
from ..operators.embedding import HashingVectorizer, ModelVectorizer, embed
from ..operators.profile import profile
from ..operators.vectors import knn
from ..schema import DocumentSchema
from ..sources.collection import Collection, scratch_collection, union_collections
from ..sources.load import load, split_valid, with_keys
from .tables import DOCUMENTS, EMBEDDINGS, Report, table

_FIELDS = [
    {"name": "c_name", "type": "text"},
    {"name": "c_mktsegment", "type": "tag"},
    {"name": "c_acctbal", "type": "numeric"},
]
CUSTOMER_HASH = DocumentSchema("customers", _FIELDS, prefix="customer:")
CUSTOMER_JSON = DocumentSchema("customers", _FIELDS, prefix="customer:", storage="json")
SUPPLIER_HASH = DocumentSchema("suppliers", [{"name": "s_name", "type": "text"}], prefix="supplier")
EVENT_HASH = DocumentSchema("events", [{"name": "event_type", "type": "tag"}], prefix="event")
CHECKED = DocumentSchema(
    "checked",
    [
        {"name": "geo", "type": "geo"},
        {"name": "c_acctbal", "type": "numeric"},
        {"name": "c_custkey", "type": "tag"},
    ],
    prefix="c",
)


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def loaded_customers(spark: SparkSession, folder: str, schema: DocumentSchema = CUSTOMER_HASH) -> Collection:
    target = scratch_collection(spark, schema)
    load(_customers(spark, folder), target, id_field="c_custkey", validate="fail")
    return target


def _bulk_load(spark, folder) -> DataFrame:
    return loaded_customers(spark, folder).read()


def _keys(spark, folder) -> DataFrame:
    rows = _customers(spark, folder)
    verbatim = rows.withColumn("own", F.concat(F.lit("k-"), "c_name"))
    given = with_keys(verbatim, CUSTOMER_HASH, keys="own").select("c_custkey", F.col("_key").alias("given"))
    return with_keys(rows, CUSTOMER_HASH, id_field="c_custkey").select("c_custkey", "_key").join(given, "c_custkey")


def _generated_keys(spark, folder) -> DataFrame:
    keyed = with_keys(_customers(spark, folder), CUSTOMER_HASH)
    return keyed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_key").alias("keys"),
        F.bool_and(F.col("_key").startswith("customer:")).alias("prefixed"),
    )


def _upsert(schema: DocumentSchema):
    def run(spark, folder) -> DataFrame:
        target = loaded_customers(spark, folder, schema)
        spent = table(spark, folder, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
        load(spent.withColumn("c_mktsegment", F.when(F.col("spent") > 1_000_000, F.lit("BIG"))), target, id_field="o_custkey")
        return target.read()

    return run


def _repeated_keys(spark, folder) -> DataFrame:
    """Every order under its customer's key in one load: the last one stays."""
    target = scratch_collection(spark, CUSTOMER_HASH)
    orders = table(spark, folder, "orders").withColumn("moment", F.struct("o_orderdate", "o_orderkey"))
    load(orders.select("o_custkey", "o_orderkey", "o_orderstatus", "moment"), target, id_field="o_custkey", order="moment")
    return target.read().select("_key", "o_orderkey", "o_orderstatus")


def _geo_rows(spark, folder) -> DataFrame:
    lon, lat = F.col("c_custkey") / 4 - 200, F.col("c_custkey") % 200 - 100
    pair = F.concat_ws(",", lon.cast("decimal(10,2)"), lat)
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rows.withColumn("geo", F.when(F.col("c_custkey") % 7 == 0, F.lit("somewhere")).otherwise(pair))


def _validation(spark, folder) -> DataFrame:
    rows = _geo_rows(spark, folder)
    messages = rows.select("c_custkey", F.explode(errors_column(rows, CHECKED)).alias("message"))
    return messages.groupBy("message").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


def _quarantine(spark, folder) -> DataFrame:
    schema = DocumentSchema("geo", [{"name": "geo", "type": "geo"}], prefix="c")
    valid, wrong = split_valid(_geo_rows(spark, folder), schema)
    return valid.select("c_custkey", F.lit(True).alias("valid")).unionByName(
        wrong.select("c_custkey", F.lit(False).alias("valid")))


def _preprocess(spark, folder) -> DataFrame:
    target = scratch_collection(spark, CUSTOMER_HASH)
    load(_customers(spark, folder), target, id_field="c_custkey",
         preprocess=lambda df: df.withColumn("c_name", F.upper("c_name")).withColumn("rich", F.col("c_acctbal") > 5000))
    return target.read().select("_key", "c_name", "rich")


def _expiry(spark, folder) -> DataFrame:
    """Events live ten days from their own time; what is left on 2024-01-25, after the purge."""
    target = scratch_collection(spark, EVENT_HASH)
    moment = F.lit("2024-01-25 00:00:00").cast("timestamp")
    load(table(spark, folder, "events").select("event_id", "ts", "event_type"), target, id_field="event_id",
         ttl=10 * 86400, now=F.col("ts").cast("timestamp"))
    target.purge(moment)
    return target.read(moment, expired=True)


def _fetch(spark, folder) -> DataFrame:
    target = loaded_customers(spark, folder)
    ids = ["17", "no such id", "3", "120", "17"]
    return target.fetch_many(ids).select("_key", "c_name", "c_acctbal", "_found")


def _fetch_table(spark, folder) -> DataFrame:
    """The customer of every order; the loaded customers are those of even number."""
    target = scratch_collection(spark, CUSTOMER_HASH)
    load(table(spark, folder, "customer").where("c_custkey % 2 = 0").select("c_custkey", "c_name"), target, id_field="c_custkey")
    asked = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return target.fetch_table(asked, "o_custkey").select("o_orderkey", "c_name", "_found")


def _two_prefixes(spark, folder) -> DataFrame:
    suppliers = scratch_collection(spark, SUPPLIER_HASH)
    load(table(spark, folder, "supplier").select("s_suppkey", "s_name"), suppliers, id_field="s_suppkey")
    both = union_collections([loaded_customers(spark, folder), suppliers])
    return both.select("_key", "_prefix", "c_name", "s_name")


def _nested(spark, folder) -> DataFrame:
    events = table(spark, folder, "events")
    schema = DocumentSchema(
        "events", [{"name": "k", "type": "numeric", "path": "$.props.k"}], storage="json", key="event_id")
    return schema.project(events).select("event_id", "k")


def _codec(spark, folder) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    scaled = F.transform("embedding", lambda v: F.round(v * 100))
    rows = rows.withColumn("f32", encoded(F.col("embedding"), "FLOAT32")).withColumn("i8", encoded(scaled, "INT8"))
    rows = rows.withColumn("same", decoded(F.col("f32"), "FLOAT32") == F.col("embedding"))
    back = decoded(F.col("i8"), "INT8").cast("array<double>")
    same8 = back == F.transform(scaled, lambda v: v.cast("double") + F.lit(0.0))
    return rows.select(
        "vec_id", F.octet_length("f32").alias("bytes32"), "same", F.octet_length("i8").alias("bytes8"), same8.alias("same8"))


def _model():
    """A tiny model: text length and two letter counts, as two token rows to be pooled."""
    return lambda texts: [[[float(len(t)), 0.0], [0.0, float(t.count("e"))]] for t in texts]


def _model_vectors(spark, folder) -> DataFrame:
    model = ModelVectorizer("letters", 2, _model)
    rows = embed(table(spark, folder, "documents").select("doc_id", "text"), "text", "vector", model)
    return rows.select("doc_id", F.round(F.col("vector")[0].cast("double"), 5).alias("x"),
                       F.round(F.col("vector")[1].cast("double"), 5).alias("y"))


def _hashed_vectors(spark, folder) -> DataFrame:
    return embed(table(spark, folder, "documents").select("doc_id", "text"), "text", "vector", HashingVectorizer(64))


def _vector_properties(spark, folder) -> DataFrame:
    """Length, unit norm, and one vector for all copies of a text."""
    vectors = _hashed_vectors(spark, folder)
    norm = F.aggregate("vector", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double") * v.cast("double"))
    copies = vectors.groupBy("text").agg(F.count_distinct("vector").alias("n"))
    return vectors.join(copies, "text").select("doc_id", F.size("vector").alias("dims"), (F.abs(norm - 1) < 1e-5).alias("unit"), (F.col("n") == 1).alias("same"))


def _embedded_search(spark, folder) -> DataFrame:
    model = HashingVectorizer(64)
    docs = embed(table(spark, folder, "documents").select("doc_id", "text"), "text", "vector", model)
    queries = embed(table(spark, folder, "benchmark"), "text", "vector", model)
    return knn(docs, field="vector", k=5, queries=queries, query_id="item_id", schema=DocumentSchema("d", key="doc_id"))


_CUSTOMER = "'customer:' || c_custkey AS _key, c_custkey, c_name, c_mktsegment, c_acctbal"
_SPENT = (
    "SELECT *, CASE WHEN spent > 1000000 THEN 'BIG' END AS big FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent "
    "FROM orders GROUP BY 1)"
)
_GEO = (
    "SELECT c_custkey, c_custkey % 7 = 0 AS bad, c_custkey / 4.0 - 200 AS lon, c_custkey % 200 - 100 AS lat FROM customer"
)
_GEO_CASE = (
    "CASE WHEN bad THEN 'Field ''geo'' should be in ''longitude,latitude'' format' "
    "WHEN lon < -180 OR lon > 180 THEN 'Field ''geo'' longitude must be between -180 and 180' "
    "WHEN lat < -90 OR lat > 90 THEN 'Field ''geo'' latitude must be between -90 and 90' END"
)

REPORTS: dict[str, Report] = {
    "S1_bulk_load": Report(_bulk_load, f"SELECT {_CUSTOMER} FROM customer"),
    "S2_keys": Report(
        _keys, "SELECT c_custkey, 'customer:' || c_custkey AS _key, 'k-' || c_name AS given FROM customer"),
    "S2_generated_keys": Report(
        _generated_keys, "SELECT count(*) AS rows, count(*) AS keys, true AS prefixed FROM customer"),
    "S3_upsert_merge": Report(
        _upsert(CUSTOMER_HASH),
        f"SELECT 'customer:' || coalesce(c_custkey, o_custkey) AS _key, c_custkey, c_name, coalesce(big, c_mktsegment) "
        f"AS c_mktsegment, c_acctbal, o_custkey, spent FROM customer FULL JOIN ({_SPENT}) ON c_custkey = o_custkey"),
    "S3_upsert_replace": Report(
        _upsert(CUSTOMER_JSON),
        f"SELECT 'customer:' || o_custkey AS _key, NULL AS c_custkey, NULL AS c_name, big AS c_mktsegment, NULL AS c_acctbal, "
        f"o_custkey, spent FROM ({_SPENT}) UNION ALL SELECT {_CUSTOMER}, NULL, NULL FROM customer "
        "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    "S3_repeated_keys_in_one_load": Report(
        _repeated_keys,
        "SELECT 'customer:' || o_custkey AS _key, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1"),
    "S4_validation": Report(
        _validation,
        f"SELECT message, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM (SELECT c_custkey, {_GEO_CASE} AS message FROM ({_GEO}) "
        "UNION ALL SELECT c_custkey, 'Field ''c_custkey'' should be string but got: bigint' FROM customer) "
        "WHERE message IS NOT NULL GROUP BY 1"),
    "S4_quarantine": Report(_quarantine, f"SELECT c_custkey, {_GEO_CASE} IS NULL AS valid FROM ({_GEO})"),
    "S5_preprocess": Report(
        _preprocess,
        "SELECT 'customer:' || c_custkey AS _key, upper(c_name) AS c_name, c_acctbal > 5000 AS rich FROM customer"),
    "S6_expiry": Report(
        _expiry,
        "SELECT 'event:' || event_id AS _key, event_id, ts, event_type FROM events "
        "WHERE ts + INTERVAL 10 DAY > TIMESTAMP '2024-01-25'"),
    "S7_fetch_many": Report(
        _fetch,
        "SELECT 'customer:' || id AS _key, c_name, c_acctbal, c_name IS NOT NULL AS _found FROM (VALUES ('17'), "
        "('no such id'), ('3'), ('120'), ('17')) v(id) LEFT JOIN customer ON c_custkey::VARCHAR = id"),
    "S7_fetch_table": Report(
        _fetch_table,
        "SELECT o_orderkey, c_name, c_custkey IS NOT NULL AS _found FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0"),
    "S8_two_prefixes": Report(
        _two_prefixes,
        "SELECT 'customer:' || c_custkey AS _key, 'customer:' AS _prefix, c_name, NULL AS s_name FROM customer UNION ALL "
        "SELECT 'supplier:' || s_suppkey, 'supplier', NULL, s_name FROM supplier"),
    "S9_nested_field": Report(_nested, "SELECT event_id, CAST(props::JSON ->> '$.k' AS DOUBLE) AS k FROM events"),
    "S10_profile": Report(
        lambda s, d: profile(table(s, d, "documents"), DOCUMENTS).withColumn("mean_tokens", F.round("mean_tokens", 4)),
        "SELECT 'text' AS field, 'text' AS role, count(*) AS rows, count(text) AS present, count(*) - count(text) AS missing, "
        "count(*) FILTER (text = '') AS empty, NULL AS dims_min, NULL AS dims_max, NULL AS bad_dims, sum(n)::BIGINT AS tokens, "
        "round(avg(n), 4) AS mean_tokens FROM (SELECT text, len(list_filter(regexp_split_to_array(lower(text), "
        r"'[^\p{L}\p{N}]+'), lambda x: x <> '')) AS n FROM documents)"
        + "".join(
            f" UNION ALL SELECT '{c}', '{r}', count(*), count({c}), count(*) - count({c}), {e}, NULL, NULL, NULL, NULL, NULL "
            "FROM documents"
            for c, r, e in (("lang", "tag", "count(*) FILTER (lang = '')"), ("source", "tag", "count(*) FILTER (source = '')"),
                            ("n_chars", "numeric", "0")))),
    "S10_profile_vectors": Report(
        lambda s, d: profile(table(s, d, "embeddings"), EMBEDDINGS).select(
            "field", "rows", "present", "dims_min", "dims_max", "bad_dims"),
        "SELECT 'embedding' AS field, count(*) AS rows, count(embedding) AS present, min(len(embedding)) AS dims_min, "
        "max(len(embedding)) AS dims_max, count(*) FILTER (len(embedding) <> 64) AS bad_dims FROM embeddings UNION ALL "
        "SELECT 'label', count(*), count(label), NULL, NULL, NULL FROM embeddings"),
    "S11_vector_bytes": Report(
        _codec, "SELECT vec_id, 256 AS bytes32, true AS same, 64 AS bytes8, true AS same8 FROM embeddings"),
    "U1_model_vectors": Report(
        _model_vectors,
        "SELECT doc_id, round((x / sqrt(x * x + y * y))::FLOAT::DOUBLE, 5) AS x, round((y / sqrt(x * x + y * y))::FLOAT::DOUBLE, 5) "
        "AS y FROM (SELECT doc_id, length(text) / 2.0::DOUBLE AS x, (length(text) - length(replace(text, 'e', ''))) / 2.0::DOUBLE "
        "AS y FROM documents)"),
    "U2_hashed_vectors": Report(_hashed_vectors),
    "U2_vector_properties": Report(_vector_properties, "SELECT doc_id, 64::INTEGER AS dims, true AS unit, true AS same FROM documents"),
    "U3_embedded_search": Report(_embedded_search),
}
