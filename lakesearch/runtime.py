"""Size checks, shared scratch space and skew helpers used by the operators."""

from __future__ import annotations

import logging
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

log = logging.getLogger("lakesearch")

# A side is broadcast only when its measured size stays below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = 16
_HIT_BYTES = 256


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that every executor can reach.

    Where that setting is absent, the folder given to ``SparkContext.setCheckpointDir``
    is taken; without either it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` cut off from its lineage by a Parquet copy in the shared folder."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for table in tables:
        files = table.inputFiles()
        if files:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of one row of ``df``."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + _FIXED_WIDTH)
        elif isinstance(f.dataType, T.ArrayType):
            parts.append(F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * 8 + _FIXED_WIDTH)
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + _FIXED_WIDTH)
        else:
            parts.append(F.lit(_FIXED_WIDTH))
    return reduce(lambda a, b: a + b, parts).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` by one aggregation job."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its measured size is below ``limit``.

    A larger side is returned unhinted, so the join shuffles and adaptive
    execution splits skewed partitions.
    """
    size = measured_bytes(df)
    if size <= limit:
        return F.broadcast(df)
    log.info("side of %d bytes exceeds the broadcast limit of %d; joining by shuffle", size, limit)
    return df


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salt_by: Column, salts: int = 32) -> DataFrame:
    """Inner equi-join that spreads every key of ``big`` over ``salts`` partitions.

    ``small`` is repeated once per salt, so a key that holds a third of ``big``
    still lands in ``salts`` tasks. Used where ``small`` is too large to broadcast.
    """
    big = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.join(small, [*on, "_salt"]).drop("_salt")


def equi_join(big: DataFrame, small: DataFrame, on: list[str], salt_by: Column) -> DataFrame:
    """Inner join of a large side with a side of unknown size, safe for hot keys."""
    if measured_bytes(small) <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on)
    return salted_join(big, small, on, salt_by)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns that later filters and projections do not recompute.

    Catalyst inlines a projected expression into every filter above it. A one-row
    ``stack`` is a generator, whose output is never inlined.
    """
    return df.select("*", F.stack(F.lit(1), *columns.values()).alias(*columns))


# Above this many rows per group Spark no longer trims a ranked window before its shuffle.
_TRIMMED = 1000
_SALTS = 32


def ranked(df: DataFrame, keys: list[str], order: list[Column], most: int, rank: str) -> DataFrame:
    """The first ``most`` rows of each group with their ``rank``, never a whole group in one task.

    Spark trims small ``most`` on the map side itself. For larger ones a first window
    over (group, salt) leaves at most ``most`` rows for each of the salts.
    """
    if most > _TRIMMED:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]), F.lit(_SALTS))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn("_salt", salt).withColumn(rank, F.row_number().over(part))
        df = df.where(F.col(rank) <= most).drop("_salt", rank)
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= most)


def with_documents(documents: DataFrame, hits: DataFrame, key: str, most: int | None) -> DataFrame:
    """Join final hits to their documents.

    ``most`` bounds the number of hits by construction (queries x k), so the hits are
    broadcast without measuring, which would run the search twice. Unbounded or large
    hits join by shuffle; document keys are unique, so adaptive execution can split a
    document that many queries found.
    """
    if most is not None and most * _HIT_BYTES <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    return documents.join(hits, key)
