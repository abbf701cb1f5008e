"""Reports for continuous load and standing queries; each drains the given table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.predicates import Num, Tag
from ..runtime import shared_folder
from ..schema import DocumentSchema
from ..sources.collection import scratch_collection
from ..streaming.ingest import standing_match, standing_queries, stream_load
from .tables import EMBEDDINGS, EVENTS, Report, table
from .vectors import _PAIRS, _one, first_vector

USERS = DocumentSchema(
    "users", [{"name": "event_type", "type": "tag"}, {"name": "value", "type": "numeric"}], prefix="user", storage="json"
)


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table as a stream, whether it is one file or a folder of them."""
    schema = table(spark, folder, name).schema
    # A stream takes a single file only by a pattern, and then the folder that partition columns are read below.
    return spark.readStream.schema(schema).option("basePath", folder).parquet(f"{folder}/{name}.parque[t]")


def drained(stream: DataFrame) -> DataFrame:
    """Run a stateless stream to its end and return what it wrote."""
    spark = stream.sparkSession
    target = shared_folder(spark, "stream")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{target}-state")
    writer.trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def _latest_per_user(spark, folder, ttl: float | None = None) -> DataFrame:
    """The last event of every user, kept up to date from the event stream."""
    target = scratch_collection(spark, USERS)
    stream = stream_of(spark, folder, "events").withColumn("moment", F.struct("ts", "event_id"))
    query = stream_load(stream, target, shared_folder(spark, "checkpoint"), id_field="user_id", order="moment", ttl=ttl,
                        validate="quarantine", available_now=True)
    query.awaitTermination()
    return target.read().select("_key", "event_id", "event_type", "value")


def _past_expiry(spark, folder) -> DataFrame:
    """Events of even users load for a minute, the others for good; read a day later."""
    target = scratch_collection(spark, USERS)
    stream = stream_of(spark, folder, "events").withColumn("moment", F.struct("ts", "event_id"))
    for ttl, own in ((60.0, "user_id % 2 = 0"), (None, "user_id % 2 = 1")):
        stream_load(stream.where(own), target, shared_folder(spark, "checkpoint"), id_field="user_id", order="moment", ttl=ttl, source=own,
                    available_now=True).awaitTermination()
    return target.read(now=F.current_timestamp() + F.expr("INTERVAL 1 DAY")).select("_key", "event_id", "event_type", "value")


def _standing_filter(spark, folder) -> DataFrame:
    stream = standing_match(stream_of(spark, folder, "events"), Tag("event_type").eq("error") & Num("value").gt(50), schema=EVENTS)
    return drained(stream.select("event_id", "user_id", "value"))


def _standing_vector(spark, folder) -> DataFrame:
    stream = standing_match(stream_of(spark, folder, "embeddings"), Num("label").lt(8), first_vector(spark, folder), "embedding",
                            0.8, schema=EMBEDDINGS)
    return drained(stream.select("vec_id", "label", F.round("vector_distance", 6).alias("vector_distance")))


def _standing_table(spark, folder) -> DataFrame:
    """Every twentieth embedding is a query with a threshold of its own, and wants another label, not under its own less two."""
    own = table(spark, folder, "embeddings").where("vec_id % 20 = 0")
    queries = own.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), (0.6 + F.col("label") / 50).alias("threshold"))
    bounds = F.array(*[F.struct(F.lit("label").alias("field"), F.lit(op).alias("op"), F.lit(None).cast("string").alias("text"), value.cast("double").alias("number"))
                       for op, value in (("ne", F.col("label")), ("ge", F.col("label") - 2))])
    conditions = own.select(F.col("vec_id").alias("query_id"), F.inline(bounds))
    target = shared_folder(spark, "matches")
    standing_queries(stream_of(spark, folder, "embeddings"), lambda _: (queries, conditions), "embedding", target, f"{target}-state",
                     available_now=True, schema=EMBEDDINGS).awaitTermination()
    return spark.read.parquet(target).select("query_id", "vec_id", F.round("vector_distance", 6).alias("vector_distance"))


_LATEST = (
    "SELECT 'user:' || user_id AS _key, event_id, event_type, value FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"
)

REPORTS: dict[str, Report] = {
    "ST1_stream_load": Report(_latest_per_user, _LATEST),
    "ST2_stream_load_with_expiry": Report(lambda s, d: _latest_per_user(s, d, 86400.0), _LATEST),
    "ST2_stream_past_expiry": Report(_past_expiry, f"{_LATEST} AND user_id % 2 = 1"),
    "ST3_standing_filter": Report(
        _standing_filter, "SELECT event_id, user_id, value FROM events WHERE event_type = 'error' AND value > 50"),
    "ST3_query_table": Report(
        _standing_table,
        f"SELECT query_id, vec_id, round(d, 6) + 0.0 AS vector_distance FROM (SELECT p.*, q.label AS own FROM ({_PAIRS}) p JOIN embeddings q "
        "ON p.query_id = q.vec_id WHERE query_id % 20 = 0) WHERE d <= 0.6 + own / 50 AND label <> own AND label >= own - 2"),
    "ST3_standing_vector": Report(
        _standing_vector,
        f"SELECT vec_id, label, round(d, 6) + 0.0 AS vector_distance FROM ({_one(where='label < 8')}) WHERE d <= 0.8"),
}
