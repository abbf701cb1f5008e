"""Document collections on Parquet: keyed appends, expiry and lookup.

A load appends its rows, one for each key, as a partition of its own, named by source and
batch; a load that is repeated overwrites that partition and nothing else (dynamic
partition overwrite). What a key holds is worked out when it is read: every row carries
its time of arrival, and a map-side aggregate takes the last value of every field. A row
may begin its key anew, as whole-row replacement and a write after expiry do; what arrived before
it no longer counts. One writer at a time for each source.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..errors import LakeSearchError, SchemaError
from ..runtime import broadcast_if_small, shared_folder, written
from ..schema import DocumentSchema

EXPIRY = "_expires_at"
ARRIVED = "_arrived"
FRESH = "_fresh"
_PARTITION = ["_source", "_batch"]
_KEPT = [ARRIVED, FRESH, *_PARTITION]
LOAD = "load"
_PUSHED_IDS = 500


class Collection:
    """A keyed document table below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: DocumentSchema):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    # -- reading -------------------------------------------------------------

    def read(self, now: Column | None = None, expired: bool = False) -> DataFrame:
        """Live rows, or with ``expired`` every stored row, without bookkeeping columns."""
        rows = self.raw()
        return (rows if expired else live_rows(rows, now)).drop(EXPIRY)

    def raw(self) -> DataFrame:
        """Every key's row with its expiry time, expired or not."""
        return last_values(self.appended(), self.schema.key)

    def appended(self) -> DataFrame:
        """All rows as they were appended, with ``_arrived``, ``_fresh``, ``_source`` and ``_batch``."""
        rows = self._stored(None)
        if rows is not None:
            return rows.withColumn("_source", F.col("_source").cast("string")).withColumn("_batch", F.col("_batch").cast("long"))
        fields = [f for f in self.schema.struct_type().fields if f.name != self.schema.key]
        return self.spark.createDataFrame([], T.StructType([T.StructField(self.schema.key, T.StringType()), *fields, *_BOOKKEEPING]))

    def _stored(self, columns: T.StructType | None) -> DataFrame | None:
        """The appended rows, of all columns that any batch has or of the given ones, which reads no file ahead; None before the first."""
        reader = self.spark.read.option("mergeSchema", "true") if columns is None else self.spark.read.schema(columns)
        try:
            return reader.option("basePath", self._data).parquet(self._data)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def fetch_many(self, ids: Iterable[str]) -> DataFrame:
        """One row per asked id in the asked order; fields are null where nothing is stored."""
        asked = list(ids)
        requests = request_frame(self.spark, asked, self.schema)
        key = self.schema.key
        rows = self.appended()
        wanted = requests.select(F.col("_wanted").cast(rows.schema[key].dataType).alias(key)).distinct()
        if len(asked) <= _PUSHED_IDS:
            # A few keys are pushed to the scan, where the statistics of the sorted files prune.
            rows = rows.where(F.col(f"`{key}`").isin([r[0] for r in wanted.collect()]))
        else:
            rows = rows.join(broadcast_if_small(wanted), key, "left_semi")
        rows = live_rows(last_values(rows, key)).drop(EXPIRY)
        return matched_requests(requests, rows, key)

    def fetch_table(self, requests: DataFrame, id_field: str) -> DataFrame:
        """Every row of ``requests`` with the stored row of its id, and ``_found``.

        Any number of requests: adaptive execution broadcasts the smaller side or joins by
        shuffle. Stored fields that ``requests`` has too are left out, null ids find nothing.
        """
        key = self.schema.key
        taken = {c.lower() for c in requests.columns}
        rows = self.read()
        stored = rows.select(F.col(f"`{key}`").cast("string").alias("_stored"), *[F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken])
        asked = requests.withColumn("_wanted", F.when(F.col(f"`{id_field}`").isNotNull(), self.schema.key_column(F.col(f"`{id_field}`"))))
        found = asked.join(stored, F.col("_wanted") == F.col("_stored"), "left")
        return found.withColumn("_found", F.col("_stored").isNotNull()).drop("_wanted", "_stored")

    def fetch(self, doc_id: str) -> DataFrame:
        return self.fetch_many([doc_id])

    # -- writing -------------------------------------------------------------

    def upsert(
        self,
        rows: DataFrame,
        mode: str | None = None,
        order: str | None = None,
        batch: tuple[str, int] | None = None,
        now: Column | None = None,
    ) -> tuple[str, int]:
        """Append prepared rows (key, fields, expiry) and return their source and batch.

        ``merge`` keeps stored fields the new row leaves null; ``replace`` swaps whole
        rows. ``order`` names the column that decides which of several rows with one
        key came last; without it, different rows of one key are an error. Without ``batch``
        a load is a batch of its own. A repeated batch takes the place of its first try, also in time.
        """
        mode = mode or ("replace" if self.schema.storage == "json" else "merge")
        if mode not in ("merge", "replace"):
            raise LakeSearchError(f"mode must be merge or replace, got {mode!r}")
        key = self.schema.key
        if EXPIRY not in rows.columns:
            rows = rows.withColumn(EXPIRY, F.lit(None).cast("timestamp"))
        stored = self._stored(T.StructType([rows.schema[key], *_BOOKKEEPING]))
        arrived = time.time_ns()
        source, number = batch or (LOAD, arrived)
        if batch is not None and stored is not None:
            first = stored.where((F.col("_source") == source) & (F.col("_batch") == number)).select(ARRIVED).first()
            arrived = first[0] if first else arrived
        new = last_rows(rows, key, order, mode)
        if mode == "replace" or stored is None:
            new = new.withColumn(FRESH, F.lit(True))
        else:
            new = self._begun_anew(new, stored.where(F.col(ARRIVED) < arrived), now)
        new = new.withColumn(ARRIVED, F.lit(arrived)).withColumn("_source", F.lit(source)).withColumn("_batch", F.lit(number))
        self._append(new)
        return source, number

    def purge(self, now: Column | None = None) -> None:
        """Overwrite the batches that hold rows of expired keys without these rows."""
        key = self.schema.key
        stored = self.appended()
        gone = written(expired_rows(last_values(stored.select(key, EXPIRY, *_KEPT), key), now).select(key), "gone")
        touched = written(stored.join(broadcast_if_small(gone), key, "left_semi").select(*_PARTITION).distinct(), "touched")
        kept = stored.join(touched, _PARTITION, "left_semi").join(broadcast_if_small(gone), key, "left_anti")
        # A batch of which nothing is left keeps a row without a key, which is never read.
        empty = touched.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields if f.name not in _PARTITION], *_PARTITION)
        self._append(written(kept.unionByName(empty), "kept"))

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _append(self, rows: DataFrame) -> None:
        rows = rows.hint("rebalance").sortWithinPartitions(*_PARTITION, self.schema.key)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTITION).parquet(self._data)

    def _begun_anew(self, new: DataFrame, stored: DataFrame, now: Column | None) -> DataFrame:
        """``new`` with ``_fresh``: whether the key had expired when the row arrived."""
        key = self.schema.key
        mortal = stored.where(F.col(EXPIRY).isNotNull())
        if mortal.isEmpty():
            return new.withColumn(FRESH, F.lit(False))
        keys = mortal.select(key).distinct()
        gone = expired_rows(last_values(stored.join(keys, key, "left_semi"), key), now)
        return new.join(gone.select(key, F.lit(True).alias("_gone")), key, "left").withColumn(FRESH, F.coalesce("_gone", F.lit(False))).drop("_gone")


_BOOKKEEPING = [
    T.StructField(EXPIRY, T.TimestampType()),
    T.StructField(ARRIVED, T.LongType()),
    T.StructField(FRESH, T.BooleanType()),
    T.StructField("_source", T.StringType()),
    T.StructField("_batch", T.LongType()),
]


def live_rows(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows whose expiry time has not passed."""
    moment = now if now is not None else F.current_timestamp()
    return rows.where(F.col(EXPIRY).isNull() | (F.col(EXPIRY) > moment))


def expired_rows(rows: DataFrame, now: Column | None = None) -> DataFrame:
    return rows.where(F.col(EXPIRY) <= (now if now is not None else F.current_timestamp()))


def last_values(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: the last value of every field since the key last began anew.

    ``max_by`` combines on the map side, so a key that a million batches wrote shrinks to one row per task.
    """
    fields = [c for c in rows.columns if c != key and c not in _KEPT]
    value = lambda c: F.struct(F.col(ARRIVED).alias("at"), F.col(f"`{c}`").alias("value"))
    last = [F.max_by(value(c), F.when(F.col(f"`{c}`").isNotNull(), F.col(ARRIVED))).alias(c) for c in fields]
    begun = F.max(F.when(F.col(FRESH), F.col(ARRIVED))).alias("_begun")
    found = rows.where(F.col(f"`{key}`").isNotNull()).groupBy(key).agg(begun, *last)
    return found.select(key, *[F.when(F.col("_begun").isNull() | (F.col(f"`{c}`.at") >= F.col("_begun")), F.col(f"`{c}`.value")).alias(c) for c in fields])


def last_rows(rows: DataFrame, key: str, order: str | None, mode: str) -> DataFrame:
    """One row per key of a load: the last row, or for ``merge`` the last value of every field.

    Without ``order`` repeated keys must be repeated rows, for a table has no order of arrival.
    """
    fields = [c for c in rows.columns if c != key]
    if order is None:
        whole = F.struct(*[F.col(f"`{c}`") for c in fields])
        plain = not any(t.startswith("map") for _, t in rows.dtypes)
        same = F.hash(whole) if plain else F.hash(F.to_json(whole))
        told = F.raise_error(F.concat(F.lit("Different rows have one key, and no column orders them: "), F.col(f"`{key}`").cast("string")))
        one = rows.groupBy(key).agg(F.first(whole).alias("_last"), (F.min(same) == F.max(same)).alias("_same"))
        return one.select(key, F.when(F.col("_same"), F.col("_last")).otherwise(told.cast(one.schema["_last"].dataType)).alias("_last")).select(key, "_last.*")
    moment = F.col(f"`{order}`")
    if mode == "replace":
        whole = F.max_by(F.struct(*[F.col(f"`{c}`") for c in fields]), moment)
        return rows.groupBy(key).agg(whole.alias("_last")).select(key, "_last.*")
    return rows.groupBy(key).agg(
        *[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), moment)).alias(c) for c in fields]
    )


def request_frame(spark: SparkSession, ids: list[str], schema: DocumentSchema) -> DataFrame:
    """``(_pos, _wanted)``: the asked ids as stored keys, in order."""
    rows = [(i, str(v)) for i, v in enumerate(ids)]
    requests = spark.createDataFrame(rows, "_pos int, _id string")
    return requests.select("_pos", schema.key_column(F.col("_id")).alias("_wanted"))


def matched_requests(requests: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Every request with its row, if any."""
    hits = rows.join(broadcast_if_small(requests), rows[key].cast("string") == requests["_wanted"])
    rest = [c for c in rows.columns if c != key]
    found = requests.join(hits.drop("_wanted"), "_pos", "left").orderBy("_pos")
    return found.select(F.col("_wanted").alias(key), *[F.col(f"`{c}`") for c in rest], F.col(f"`{key}`").isNotNull().alias("_found"))


def union_collections(collections: Iterable[Collection]) -> DataFrame:
    """Several collections as one table, each row tagged with its key prefix."""
    frames = [c.read().withColumn("_prefix", F.lit(c.schema.prefixes[0])) for c in collections]
    if not frames:
        raise SchemaError("union_collections needs at least one collection")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scratch_collection(spark: SparkSession, schema: DocumentSchema) -> Collection:
    """A collection in a fresh folder of the shared scratch space."""
    return Collection(spark, shared_folder(spark, "collection"), schema)
