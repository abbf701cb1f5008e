"""Field references: ``name``, ``@name`` and ``$.path`` to Spark columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import QueryError


def reference_name(ref: str) -> str:
    """The column name a reference exposes (``@price`` and ``$.a.b`` included)."""
    if not isinstance(ref, str) or not ref.strip():
        raise QueryError("A field reference cannot be empty")
    ref = ref.strip()
    if ref.startswith("@"):
        return ref[1:]
    if ref.startswith("$"):
        if not ref.startswith("$."):
            raise QueryError(f"Field reference '{ref}' is neither a field name nor a path; use '$.{ref[1:]}'")
        return ref[2:].split(".")[-1]
    return ref


def path_column(df: DataFrame, path: str) -> Column:
    """The value at ``$.a.b``: struct access, or JSON access inside a string column."""
    parts = path[2:].split(".")
    dtype: T.DataType = df.schema
    for depth, part in enumerate(parts):
        if isinstance(dtype, T.StructType) and part in dtype.fieldNames():
            dtype = dtype[part].dataType
            continue
        if isinstance(dtype, T.MapType):
            return _quoted(parts[:depth]).getItem(part)
        if isinstance(dtype, T.StringType) and depth:
            return F.get_json_object(_quoted(parts[:depth]), "$." + ".".join(parts[depth:]))
        if isinstance(dtype, T.VariantType) and depth:
            return F.try_variant_get(_quoted(parts[:depth]), "$." + ".".join(parts[depth:]), "string")
        raise QueryError(f"Path '{path}' does not lead to a column")
    return _quoted(parts)


def field_column(df: DataFrame, ref: str) -> Column:
    """Resolve any accepted reference against ``df``."""
    name = reference_name(ref)
    if ref.strip().startswith("$."):
        return path_column(df, ref.strip())
    return F.col(name) if re.fullmatch(r"\w+(\.\w+)+", name) and name not in df.columns else F.col(f"`{name}`")


def expression_sql(text: str) -> str:
    """A Spark SQL expression in which ``@name`` may stand for ``name``.

    Quoted strings and back-quoted names are left as they are.
    """
    pieces = re.split(r"('(?:[^'\\]|\\.|'')*'|`[^`]*`)", text)
    return "".join(p if i % 2 else re.sub(r"@(?=[A-Za-z_])", "", p) for i, p in enumerate(pieces))


def _quoted(parts: list[str]) -> Column:
    return F.col(".".join(f"`{p}`" for p in parts))
