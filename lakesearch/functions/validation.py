"""Checks of document values against a schema, as one projected column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import DATATYPES, DocumentSchema, Field
from .predicates import geo_point


def errors_column(df: DataFrame, schema: DocumentSchema) -> Column:
    """``array<string>`` with one message per declared, non-null field that is wrong."""
    found = []
    for spec in schema.fields.values():
        name = spec.alias
        if name in df.columns:
            value = F.col(f"`{name}`")
            found.append(F.when(value.isNotNull(), _error(spec, name, value, df.schema[name].dataType)))
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))


def _error(spec: Field, name: str, value: Column, dtype: T.DataType) -> Column:
    none = F.lit(None).cast("string")
    if spec.role == "numeric":
        good = isinstance(dtype, T.NumericType)
        return none if good else F.lit(f"Field '{name}' should be numeric but got: {dtype.simpleString()}")
    if spec.role == "vector":
        return _vector_error(spec, name, value, dtype)
    if spec.role == "tag" and isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
        return none
    if not isinstance(dtype, T.StringType):
        return F.lit(f"Field '{name}' should be string but got: {dtype.simpleString()}")
    if spec.role != "geo":
        return none
    lon, lat = geo_point(value)
    return (
        F.when(F.size(F.split(F.trim(value), ",")) != 2, F.lit(f"Field '{name}' should be in 'longitude,latitude' format"))
        .when(lon.isNull() | lat.isNull() | F.isnan(lon) | F.isnan(lat), F.lit(f"Field '{name}' contains invalid coordinates"))
        .when((lon < -180) | (lon > 180), F.lit(f"Field '{name}' longitude must be between -180 and 180"))
        .when((lat < -90) | (lat > 90), F.lit(f"Field '{name}' latitude must be between -90 and 90"))
    )


def _vector_error(spec: Field, name: str, value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        dims = F.octet_length(value) / F.lit(DATATYPES[spec.datatype][0])
        bad_element = F.lit(False)
    elif isinstance(dtype, T.ArrayType):
        if not isinstance(dtype.elementType, T.NumericType):
            return F.lit(f"Vector field '{name}' contains non-numeric values: {dtype.elementType.simpleString()}")
        dims = F.size(value)
        bad_element = F.exists(value, lambda v: v.isNull())
    else:
        return F.lit(f"Field '{name}' expects a vector (array or bytes), but got {dtype.simpleString()}")
    error = F.when(
        dims != F.lit(spec.dims),
        F.concat(
            F.lit(f"Vector field '{name}' has incorrect dimensions. Expected {spec.dims} but got "), dims.cast("string")
        ),
    )
    return error.when(bad_element, F.lit(f"Vector field '{name}' contains a non-numeric value"))
