"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target / source size copies. Documents are laid
out by size within their source; their expected copies are summed up in that order,
one random offset is added, and a document is taken once for every integer that its
own stretch crosses. Equal sizes lie side by side, so taken words come near the target.

The running sum is a rank times a constant. Ranks are built from counts on four
levels (binary digits of the size, size, hash prefix of the key, key), so a source that
holds most documents is never sorted in one task. Only DataFrame functions are used.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, table, with_columns

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 42
ROWS_PER_PREFIX = 50_000


def offset(seed: int) -> float:
    """The one random offset of a mix."""
    return random.Random(seed).random()


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, source: str, size: str, weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """``_source, _sid, source_size, target`` of each source.

    Sources in code-point order, null last, take the weights in turn and share the sum
    of all sizes. A target stops at ``most_copies`` times its source's size and the
    excess is shared again: the common level is the first that its source and all later
    ones, by size over weight, can bear. Ranks sources, not documents, in one task.
    """
    per = sized.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    turn = Window.orderBy(F.col("_source").asc_nulls_last())
    per = per.withColumn("_sid", F.row_number().over(turn) - 1)
    per = per.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_sid") % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", F.col("source_size") * most_copies)
    per = per.withColumn("_ratio", F.col("_cap").cast("double") / F.col("_weight"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("_ratio", "_sid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_total", F.sum("source_size").over(everything)).withColumn("_all", F.sum("_weight").over(everything))
    left = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double")
    level = left / (F.col("_all") - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    per = per.withColumn("_level", level)
    per = per.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_sid", "_level"))).over(everything)["_level"])
    target = F.least(F.col("_weight") * F.col("_level"), F.col("_cap").cast("double"))
    return per.select("_source", "_sid", "source_size", target.alias("target"))


def mixed(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, most_copies: int = MOST_COPIES, seed: int = SEED
) -> DataFrame:
    """Every row with ``size`` (words), ``source_size``, ``target`` (its source's), ``copies`` and ``taken``.

    ``taken`` is ``copies`` x ``size``; ``copies`` is at most ``most_copies``. New columns
    replace input columns of those names. Null texts have size 0; a null source is a
    source of its own; null keys are one key. Repeated rows are taken one after the other. The same input
    gives the same mix in any partitioning (among rows of equal key, source and size,
    which of them is taken is arbitrary).
    """
    rows = df.select("*", F.col(key).cast("string").alias("_key"), F.col(source).alias("_from"), n_words(text).alias("_size"))
    per = targets(rows.select("_from", "_size"), "_from", "_size", weights, most_copies)
    per = per.withColumnsRenamed({"source_size": "_z", "target": "_t"})
    rows = rows.join(per, F.col("_from").eqNullSafe(F.col("_source"))).drop("_source", "_from")
    slim = rows.select("_sid", "_size", F.coalesce("_key", F.lit("")).alias("_key"))
    n, digits = df.count(), 0
    while ROWS_PER_PREFIX * 16**digits < n and digits < 8:
        digits += 1
    slim = slim.select("*", F.md5(F.col("_key")).alias("_hash"))
    units = slim.groupBy("_sid", "_size", "_key", "_hash").agg(F.count("*").alias("_n"))
    units = units.withColumn("_octave", F.length(F.bin("_size"))).withColumn("_prefix", F.substring("_hash", 1, digits))

    def running(counts: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
        before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn(name, F.coalesce(F.sum("_n").over(before), F.lit(0)))

    prefixes = units.groupBy("_sid", "_octave", "_size", "_prefix").agg(F.sum("_n").alias("_n"))
    sizes = prefixes.groupBy("_sid", "_octave", "_size").agg(F.sum("_n").alias("_n"))
    octaves = sizes.groupBy("_sid", "_octave").agg(F.sum("_n").alias("_n"))
    octaves = running(octaves, ["_sid"], ["_octave"], "_a").drop("_n")
    sizes = running(sizes, ["_sid", "_octave"], ["_size"], "_b").drop("_n").join(octaves, ["_sid", "_octave"])
    prefixes = running(prefixes, ["_sid", "_size"], ["_prefix"], "_c").drop("_n", "_octave").join(sizes, ["_sid", "_size"])
    units = running(units.drop("_octave"), ["_sid", "_size", "_prefix"], ["_hash", "_key"], "_d").join(prefixes, ["_sid", "_size", "_prefix"])
    units = units.select("_sid", "_size", F.col("_key").alias("_unit"), (F.col("_a") + F.col("_b") + F.col("_c") + F.col("_d")).alias("_base"))

    same = Window.partitionBy("_sid", "_size", "_unit").orderBy(F.lit(0))
    rows = rows.withColumn("_unit", F.coalesce("_key", F.lit(""))).withColumn("_repeat", F.row_number().over(same) - 1)
    rows = rows.join(units, ["_sid", "_size", "_unit"])
    rate = F.when(F.col("_z") > 0, F.col("_t") / F.col("_z")).otherwise(F.lit(0.0))
    at = (F.col("_base") + F.col("_repeat")).cast("double")
    copies = F.floor((at + 1) * F.col("_rate") + offset(seed)) - F.floor(at * F.col("_rate") + offset(seed))
    rows = rows.withColumn("_rate", rate).withColumn("_copies", copies)
    found = rows.select(*[F.col(f"`{c}`") for c in df.columns], "_size", "_z", "_t", "_copies")
    out = with_columns(found, size=F.col("_size"), source_size=F.col("_z"), target=F.col("_t"), copies=F.col("_copies"), taken=F.col("_copies") * F.col("_size"))
    return out.drop("_size", "_z", "_t", "_copies")


def mixed_documents(spark, folder: str) -> DataFrame:
    """op9: how many words of each document the mix takes."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixing_stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """The mix itself: each document as many times as it is taken, numbered by ``copy`` from 1, which replaces a column of that name."""
    taken = mixed(docs).where("copies > 0")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "copy"]
    return taken.select(*kept, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM per
), levels AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS ratio,
    ((sum(source_size) OVER ())::BIGINT - COALESCE(sum(3 * source_size) OVER (ORDER BY (3 * source_size)::DOUBLE / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
    / ((sum(weight) OVER ())::BIGINT - COALESCE(sum(weight) OVER (ORDER BY (3 * source_size)::DOUBLE / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT) AS level
  FROM weighed
), chosen AS (
  SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, sid LIMIT 1
), goals AS (
  SELECT source, source_size, least(weight * chosen.level, (3 * source_size)::DOUBLE) AS target FROM levels, chosen
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
    (row_number() OVER (PARTITION BY s.source ORDER BY s.size, md5(COALESCE(s.doc_id::VARCHAR, '')), s.doc_id::VARCHAR) - 1)::DOUBLE AS place
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  ((floor((place + 1) * rate + {offset(SEED)!r}) - floor(place * rate + {offset(SEED)!r})) * size)::BIGINT AS taken
FROM placed
"""
