"""Exact quantiles of grouped values by radix selection: no group is ever ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import BROADCAST_BYTES, measured_bytes, written

# Bits of the significand in each digit; the first goes with sign and exponent.
DIGIT_BITS = (6, 15, 15, 16)
_LOWEST, _SCALE = -1000, 100


def sortable_digits(value: Column) -> list[Column]:
    """Numbers that order doubles when compared one after the other.

    The first holds sign, exponent and the leading bits of the significand. Both zeros are equal and NaN
    is greater than infinity, as in Spark's own order. Powers of two are exact, so no bit is lost.
    """
    size = F.abs(value)
    tiny = size < F.lit(2.0**_LOWEST)  # moved away from the subnormal numbers
    moved = F.when(tiny, size * F.lit(2.0**_SCALE)).otherwise(size)
    guess = F.floor(F.log2(moved))
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(moved >= power * 2, 1).otherwise(0) - F.when(moved < power, 1).otherwise(0)
    bits = ((moved / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0**52)).cast("long")
    place = exponent - F.when(tiny, _SCALE).otherwise(0) - (_LOWEST - _SCALE)
    odd = F.isnan(value) | (size == float("inf")) | (value == 0)
    place = F.when(F.isnan(value), 2 * -_LOWEST + 300).when(size == float("inf"), 2 * -_LOWEST + 200).when(value == 0, 0).otherwise(place)
    bits = F.when(odd, F.lit(0)).otherwise(bits).cast("long")
    sign = F.when((value < 0) & ~F.isnan(value), -1).otherwise(1)
    out, left = [], 52
    for width in DIGIT_BITS:
        left -= width
        digit = F.shiftright(bits, left).bitwiseAND(F.lit((1 << width) - 1))
        out.append(sign * (digit if out else place * (1 << width) + digit))
    return [d.cast("long") for d in out]


def exact_quantile(df: DataFrame, keys: list[str], value: Column, q: float, alias: str) -> DataFrame:
    """``keys`` and the linearly interpolated ``q`` quantile of ``value`` per group, null values aside.

    For each digit of the values one aggregate counts the values by digit, and only those whose digits so
    far lead to a wanted rank go on to the next. A window orders the digits of one prefix, of which
    there are at most 2^16 (the first: as many as there are exponents), never the values. A group whose
    values agree is done early.
    """
    group = F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.lit(1)
    rows = df.select(*keys, group.alias("_g"), value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    names = [f"_d{i}" for i in range(len(DIGIT_BITS))]
    digits = rows.select("_g", "_v", *[d.alias(n) for d, n in zip(sortable_digits(F.col("_v")), names, strict=True)])
    rank = F.lit(float(q)) * (F.count("*") - 1)
    ranks = rows.groupBy("_g").agg(*[F.first(k).alias(k) for k in keys], rank.alias("_rank"))
    ranks = written(ranks.select("*", F.floor("_rank").cast("long").alias("_low"), F.ceil("_rank").cast("long").alias("_high")), "ranks")
    wanted = ranks.select("_g", F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_want")).withColumn("_left", F.col("_want"))
    found = None
    for i, name in enumerate(names):
        prefix = ["_g", *names[:i]]
        some = digits if i == 0 else _only(digits, wanted.select(*prefix).distinct(), prefix)
        counts = some.groupBy(*prefix, name).agg(F.count("*").alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        upto = F.sum("_n").over(Window.partitionBy(*prefix).orderBy(name))
        counts = counts.withColumn("_end", upto)
        hits = wanted.join(counts, prefix).where((F.col("_left") < F.col("_end")) & (F.col("_left") >= F.col("_end") - F.col("_n")))
        hits = hits.withColumn("_left", F.col("_left") - (F.col("_end") - F.col("_n")))
        hits = written(hits.select("_g", "_want", "_left", *names[: i + 1], "_from", "_to"), "digits")
        settled = F.col("_from").eqNullSafe(F.col("_to")) | F.lit(i == len(names) - 1)
        done = hits.where(settled).select("_g", "_want", F.col("_from").alias("_v"))
        found = done if found is None else found.unionByName(done)
        wanted = hits.where(~settled).select("_g", "_want", "_left", *names[: i + 1])
        if wanted.isEmpty():
            break
    low = found.select("_g", F.col("_want").alias("_low"), F.col("_v").alias("_a"))
    high = found.select("_g", F.col("_want").alias("_high"), F.col("_v").alias("_b"))
    both = ranks.join(low, ["_g", "_low"]).join(high, ["_g", "_high"])
    between = F.col("_a") + (F.col("_rank") - F.col("_low")) * (F.col("_b") - F.col("_a"))
    answer = F.when((F.col("_rank") == F.col("_low")) | (F.col("_a") == F.col("_b")), F.col("_a")).otherwise(between)
    return both.select(*keys, answer.alias(alias))


def _only(rows: DataFrame, prefixes: DataFrame, on: list[str]) -> DataFrame:
    """Rows with one of the prefixes; a prefix that very many rows have stays where they are if the prefixes fit a broadcast."""
    return rows.join(F.broadcast(prefixes) if measured_bytes(prefixes) <= BROADCAST_BYTES else prefixes, on, "left_semi")
