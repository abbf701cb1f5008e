"""Continuous load and standing queries with Structured Streaming.

Standing queries may be literals of a stateless stream, or a table that every micro-batch
reads anew: its vectors meet the micro-batch in the kernel of batch search, and its filters
are rows of a table of conditions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import QueryError
from ..functions.distance import distance_column
from ..functions.predicates import FilterInput, filtered
from ..operators.vectors import DEFAULT_ALIAS, batch_search, search_metric, vector_name
from ..runtime import computed_once
from ..schema import DocumentSchema
from ..sources.collection import Collection
from ..sources.load import load


def stream_load(
    stream: DataFrame,
    target: Collection,
    checkpoint: str,
    id_field: str | None = None,
    keys: str | None = None,
    ttl: float | None = None,
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
    validate: str = "off",
    mode: str | None = None,
    order: str | None = None,
    quarantine: str | None = None,
    source: str = "stream",
    available_now: bool = False,
) -> StreamingQuery:
    """Append every micro-batch of a stream to a collection.

    A micro-batch writes only its own rows, under ``source`` and its number, so one that is
    replayed after a failure overwrites its first try. Rejected rows go to one folder per batch below
    ``quarantine``; expiry counts from the time of the micro-batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            result = load(
                rows, target, id_field, keys, ttl, preprocess, validate, mode, order, batch=(source, number)
            )
            if result.rejected is not None and quarantine is not None:
                result.rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def standing_match(
    stream: DataFrame,
    where: FilterInput = None,
    vector: Sequence[float] | None = None,
    field: str = "",
    threshold: float = 0.2,
    metric: str | None = None,
    alias: str = DEFAULT_ALIAS,
    schema: DocumentSchema | None = None,
) -> DataFrame:
    """Rows of a stream that match a filter and, with a vector, lie within a distance.

    The result is a stateless stream, so it keeps no history and needs no watermark.
    """
    rows = filtered(stream, where, schema)
    if vector is None:
        return rows
    name = search_metric(schema, field, metric)
    rows = rows.withColumn("_vector", F.col(f"`{vector_name(schema, field)}`")).drop(alias)
    found = computed_once(rows, **{alias: distance_column(F.col("_vector"), vector, name)})
    return found.drop("_vector").where(F.col(alias) <= threshold)


CONDITIONS = ("eq", "ne", "lt", "le", "gt", "ge")


def match_queries(
    rows: DataFrame,
    queries: DataFrame,
    field: str,
    conditions: DataFrame | None = None,
    query_id: str = "query_id",
    query_vector: str = "vector",
    threshold: str = "threshold",
    metric: str | None = None,
    alias: str = DEFAULT_ALIAS,
    schema: DocumentSchema | None = None,
) -> DataFrame:
    """``(query_id, key, distance)`` of the rows within each query's own threshold that meet all its conditions.

    ``conditions`` has ``query_id, field, op, text, number``: ``op`` is one of eq, ne, lt, le, gt, ge and compares
    the field with ``number``, or with ``text`` where that is set. A missing value meets no condition; a query
    without conditions has only its distance to meet. Conditions are tried on pairs that are near enough, so
    rows and queries are never all paired.
    """
    key = schema.key if schema is not None else "_key"
    name = search_metric(schema, field, metric)
    widest = queries.agg(F.max(F.col(f"`{threshold}`").cast("double"))).first()[0]
    own = queries.select(F.col(f"`{query_id}`"), F.col(f"`{query_vector}`"), F.col(f"`{threshold}`").cast("double").alias("_most"))
    near = batch_search(rows, own, vector_name(schema, field), name, key, query_id, query_vector, radius=-1.0 if widest is None else widest, alias=alias)
    near = near.join(own.select(query_id, "_most"), query_id).where(F.col(alias) <= F.col("_most")).drop("_most")
    if conditions is None:
        return near
    wanted = [r[0] for r in conditions.select("field").distinct().collect()]
    missing = [c for c in wanted if c not in rows.columns]
    if missing:
        raise QueryError(f"Conditions name fields that the stream does not have: {', '.join(sorted(missing))}")
    told = rows.select(key, F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("text"), F.col(f"`{c}`").try_cast("double").alias("number")) for c in wanted]).alias("_values"))
    told = told.join(near.select(key).distinct(), key, "left_semi").select(key, F.inline("_values")).toDF(key, "field", "_text", "_number")
    asked = conditions.select(query_id, "field", "op", "text", "number")
    tried = near.join(asked, query_id).join(told, [key, "field"], "left")
    kept = F.when(F.col("text").isNotNull(), _meets(F.col("_text"), F.col("text"))).otherwise(_meets(F.col("_number"), F.col("number")))
    failed = tried.groupBy(query_id, key).agg(F.bool_and(F.coalesce(kept, F.lit(False))).alias("_kept")).where(~F.col("_kept"))
    return near.join(failed, [query_id, key], "left_anti")


def _meets(value: Column, other: Column) -> Column:
    tests = {"eq": value == other, "ne": value != other, "lt": value < other, "le": value <= other, "gt": value > other, "ge": value >= other}
    out = F.lit(None).cast("boolean")
    for op in CONDITIONS:
        out = F.when(F.col("op") == op, tests[op]).otherwise(out)
    return out


def standing_queries(
    stream: DataFrame,
    read: Callable[[SparkSession], tuple[DataFrame, DataFrame | None]],
    field: str,
    target: str,
    checkpoint: str,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Match every micro-batch against tables of queries and conditions that ``read`` returns anew each time.

    Matches are appended below ``target`` under ``batch=<number>``; a repeated micro-batch overwrites its own.
    ``options`` are those of ``match_queries``.
    """

    def match(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            queries, conditions = read(batch.sparkSession)
            match_queries(rows, queries, field, conditions, **options).write.mode("overwrite").parquet(f"{target}/batch={number}")
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(match).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
