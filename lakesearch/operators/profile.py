"""Collection profile: field statistics of a document table in one aggregation job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import tokens
from ..runtime import computed_once
from ..schema import DATATYPES, DocumentSchema

_COLUMNS = (
    "field string, role string, rows bigint, present bigint, missing bigint, empty bigint, "
    "dims_min bigint, dims_max bigint, bad_dims bigint, tokens bigint, mean_tokens double"
)


def profile(df: DataFrame, schema: DocumentSchema) -> DataFrame:
    """One row per declared field: counts, vector dimensions and text lengths."""
    fields = [f for f in schema.fields.values() if f.alias in df.columns]
    types = {f.alias: df.schema[f.alias].dataType for f in fields}
    sizes = {f"_size{i}": _size(f, types[f.alias]) for i, f in enumerate(fields)}
    sized = computed_once(df, **sizes) if sizes else df
    wanted = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        value, size = F.col(f"`{f.alias}`"), F.col(f"_size{i}")
        wanted.append(F.count(value).alias(f"present{i}"))
        empty = value == "" if isinstance(types[f.alias], T.StringType) else size == 0
        wanted.append(F.count_if(F.coalesce(empty, F.lit(False))).alias(f"empty{i}"))
        if f.role == "vector":
            wanted += [F.min(size).alias(f"low{i}"), F.max(size).alias(f"high{i}")]
            wanted.append(F.count_if(F.coalesce(size != F.lit(f.dims), F.lit(False))).alias(f"bad{i}"))
        if f.role == "text":
            wanted += [F.sum(size).alias(f"sum{i}"), F.avg(size).alias(f"mean{i}")]
    totals = sized.agg(*wanted)
    null = F.lit(None)
    cells: list[Column] = []
    for i, f in enumerate(fields):
        vector, text = f.role == "vector", f.role == "text"
        cells += [
            F.lit(f.alias), F.lit(f.role), F.col("_rows"), F.col(f"present{i}"), F.col("_rows") - F.col(f"present{i}"),
            F.col(f"empty{i}"),
            *[(F.col(f"{n}{i}") if vector else null).cast("bigint") for n in ("low", "high", "bad")],
            (F.col(f"sum{i}") if text else null).cast("bigint"),
            (F.col(f"mean{i}") if text else null).cast("double"),
        ]
    names = [part.split()[0] for part in _COLUMNS.split(", ")]
    return totals.select(F.stack(F.lit(len(fields)), *cells).alias(*names))


def _size(f, dtype: T.DataType) -> Column:
    value = F.col(f"`{f.alias}`")
    if f.role == "text":
        return F.size(tokens(value))
    if isinstance(dtype, T.ArrayType):
        return F.size(value)
    if isinstance(dtype, T.BinaryType) and f.role == "vector":
        return (F.octet_length(value) / DATATYPES[f.datatype][0]).cast("int")
    return F.lit(None).cast("int")


