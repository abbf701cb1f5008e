"""Exact deduplication of whole texts by a stateful stream.

Documents stream in; state is keyed by the digest of the text, kept on disk (RocksDB) and
never expires. It holds the digest, how many rows had it, the stable identifier of the row
that stays and the place of that row's text (file and row number), never a text. Each
micro-batch appends the state rows it changed under its own number, so a replayed batch
overwrites itself, and a later call with the same ``state`` folder reads new files only.

A digest is only a hint. Every row whose digest the state had already seen is a hit, and
its full bytes are compared with those at the place that the state names. Digests with
a row that differs are grouped anew by whole texts. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..runtime import shared_folder, written
from .common import small, with_columns

BYTES_PER_BATCH = 64 << 30
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _placed(source: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows with ``_digest``, ``_text`` (null: empty) and ``_at``: the key and the place of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    at = F.struct(F.col(key).alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return source.select("*", whole.alias("_text"), digest(whole).alias("_digest"), at.alias("_at"))


def _streamed(path: str) -> str:
    """``path`` as a pattern, because a stream takes a single file by a pattern only."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def collect_state(
    spark: SparkSession, path: str, schema: T.StructType, key: str, text: str, state: str, digest: Callable[[Column], Column] = sha256, bytes_per_batch: int = BYTES_PER_BATCH
) -> DataFrame:
    """``_digest, _kept, _n`` of all files below ``path``, carried on from earlier calls with this ``state`` folder."""
    rows = _placed(spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(_streamed(path)), key, text, digest)
    keyed = rows.groupBy("_digest").agg(F.max("_at").alias("_kept"), F.count("*").alias("_n"))

    def append(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{state}/changed/batch={number}")

    append(spark.createDataFrame([], keyed.schema), -1)
    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    try:
        for name, value in STATE_CONF.items():
            spark.conf.set(name, value)
        stream = keyed.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{state}/checkpoint")
        stream.trigger(availableNow=True).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    changed = spark.read.schema(T.StructType([*keyed.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{state}/changed")
    last = changed.groupBy("_digest").agg(F.max(F.struct("batch", "_kept", "_n")).alias("_last"))
    return last.select("_digest", "_last._kept", "_last._n")


def unequal_digests(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The digest of each row whose bytes differ from those at the place that the state names.

    Only rows of ``hits`` are shuffled. Adaptive execution splits a digest of very many rows, as nothing
    after the join needs a digest's rows together.
    """
    seen = rows.select("_digest", "_text", "_at").join(hits.select("_digest", "_kept"), "_digest")
    named = seen.where(F.col("_at") == F.col("_kept")).select("_digest", F.col("_text").alias("_bytes"))
    return seen.where(F.col("_at") != F.col("_kept")).join(named.hint("merge"), "_digest").where(F.col("_text") != F.col("_bytes")).select("_digest")


def deduplicated(
    spark: SparkSession,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    state: str | None = None,
    digest: Callable[[Column], Column] = sha256,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> DataFrame:
    """Every row of the Parquet files below ``path`` with ``keep_id, group_size, kept`` and ``text_sha256``.

    Texts are equal when all their bytes are; null counts as empty. Of equal texts the row
    with the largest key stays (null keys are the smallest; of repeated rows with one key,
    the last by file and row number), so ``kept`` is true exactly once for each text.
    ``keep_id`` is that row's key. New columns replace input columns of those names; an
    empty table gives an empty result. ``state`` is a folder in shared storage that holds
    the stream's progress and state; a new one below ``spark.checkpoint.dir`` by default.
    Files are never changed once loaded. ``digest`` may collide; the answer does not change.
    """
    schema = spark.read.parquet(path).schema
    held = collect_state(spark, path, schema, key, text, state or shared_folder(spark, "exact"), digest, bytes_per_batch)
    rows = _placed(spark.read.schema(schema).parquet(path), key, text, digest)
    hits = written(held.where("_n > 1"), "hits")
    unequal = written(unequal_digests(rows, small(hits)), "unequal").distinct()
    if unequal.isEmpty():
        found = rows.join(small(hits), "_digest", "left")
    else:
        split = rows.join(unequal, "_digest", "left_semi")
        texts = split.groupBy("_text").agg(F.max("_at").alias("_kept"), F.count("*").alias("_n"))
        whole = rows.join(unequal, "_digest", "left_anti").join(hits, "_digest", "left")
        found = whole.unionByName(split.join(texts, "_text"))
    kept = F.coalesce(F.col("_kept"), F.col("_at"))
    names = [c for c in schema.names if c.lower() not in ("keep_id", "group_size", "kept", "text_sha256")]
    out = with_columns(found, keep_id=kept["key"], group_size=F.coalesce("_n", F.lit(1)).cast("long"), kept=F.col("_at") == kept, text_sha256=F.sha2("_text", 256))
    return out.select(*[F.col(f"`{c}`") for c in names], "keep_id", "group_size", "kept", "text_sha256")


def exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    """op13: for every document, the one of its text that stays."""
    return deduplicated(spark, f"{folder}/documents.parquet").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY COALESCE(text, ''))
"""
