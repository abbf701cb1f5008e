"""Stored sketches: distinct counts and quantiles of any range of days and groups without a look at the rows.

One row for each day and group holds a count, a HyperLogLog sketch of each distinct field and a KLL
sketch of each quantile field. A range merges rows, so its cost follows from days and groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..checks import unit_interval
from ..errors import QueryError

ROWS = "_rows"
# Fixed: 2^13 registers err by about 1.15 %, a KLL sketch of this size by about 0.7 % of the ranks.
LOG_REGISTERS, KLL_SIZE = 13, 512


class SketchTable:
    """Sketches below ``path`` by ``day`` and ``keys``."""

    def __init__(self, spark: SparkSession, path: str, day: str, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = ()):
        self._spark, self._path, self._day = spark, path, day
        self._keys, self._distinct, self._quantiles = list(keys), list(distinct), list(quantiles)

    def add(self, df: DataFrame) -> None:
        """Sketch whole days: a day that is stored already is replaced, all others stay. Null values do not count."""
        counted = [F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(c)), LOG_REGISTERS) for c in self._distinct]
        ranked = [F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE) for c in self._quantiles]
        named = [v.alias(f"distinct_{c}") for c, v in zip(self._distinct, counted, strict=True)]
        named += [v.alias(f"quantile_{c}") for c, v in zip(self._quantiles, ranked, strict=True)]
        rows = df.groupBy(self._day, *self._keys).agg(F.count("*").alias(ROWS), *named)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self._day).parquet(self._path)

    def stored(self) -> DataFrame | None:
        try:
            return self._spark.read.option("basePath", self._path).parquet(self._path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def summary(self, by: Sequence[str] = (), where: Column | None = None, quantile: float = 0.5) -> DataFrame:
        """``by``, ``rows``, ``distinct_<field>`` and ``quantile_<field>`` of the stored days and groups that meet ``where``."""
        unit_interval(quantile, "quantile")
        rows = self.stored()
        if rows is None:
            raise QueryError("No day is stored")
        rows = rows if where is None else rows.where(where)
        out = [F.sum(ROWS).alias("rows")]
        out += [F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{c}")).alias(f"distinct_{c}") for c in self._distinct]
        out += [F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"quantile_{c}"), F.lit(float(quantile))).alias(f"quantile_{c}") for c in self._quantiles]
        return rows.groupBy(*by).agg(*out)
