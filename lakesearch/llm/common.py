"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..runtime import BROADCAST_BYTES, measured_bytes

# White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Query:
    """A registered query, and the SQL that must return the same rows where SQL can say it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of ``key`` as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % folds


def in_fold(key: str, folds: int, held: int) -> Column:
    """Whether a row is held out; a null key is, so nothing is learnt from it."""
    return F.coalesce(fold(key, folds) == held, F.lit(True))


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with new columns at the end; they replace input columns of the same name in any case."""
    new = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new], *[v.alias(k) for k, v in columns.items()])


def identity(key: str, text: str) -> Column:
    """16 bytes that tell a document by its key and text; null for a null text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\n"), F.col(text))))


def small(df: DataFrame) -> DataFrame:
    """A written table with a broadcast hint if its measured size is below the limit; else a shuffle join follows."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def most_frequent(counts: DataFrame, group: list[str], n: str, most: int) -> DataFrame:
    """Rows of each group with the largest ``n``, at most ``most`` of them.

    The smallest count that still fits is found on the histogram of counts, so no
    group meets in one task. Rows tied at the border all go.
    """
    histogram = counts.groupBy(*group, n).agg(F.count("*").alias("_rows"))
    falling = Window.partitionBy(*group).orderBy(F.col(n).desc())
    border = (
        histogram.withColumn("_sum", F.sum("_rows").over(falling))
        .where(F.col("_sum") <= most)
        .groupBy(*group)
        .agg(F.min(n).alias("_least"))
    )
    return counts.join(border, group).where(F.col(n) >= F.col("_least")).drop("_least")
