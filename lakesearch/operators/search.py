"""Filter and count queries, projection, sorting and paging."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..checks import natural_int, one_of, positive_int
from ..functions.predicates import FilterInput, filtered
from ..functions.refs import field_column, reference_name
from ..schema import DocumentSchema

DEFAULT_PAGE = 10


def project_fields(
    df: DataFrame, schema: DocumentSchema | None, fields: Iterable[str] | None, extra: Iterable[str] = ()
) -> DataFrame:
    """The key, the asked fields (all when ``None``) and the ``extra`` columns, without repeats."""
    if fields is None:
        return df
    key = schema.key if schema is not None else "_key"
    out = {key: F.col(f"`{key}`")} if key in df.columns else {}
    for ref in fields:
        spec = schema.field(reference_name(ref)) if schema is not None else None
        name = spec.alias if spec is not None else reference_name(ref)
        if name not in out:
            column = F.col(f"`{name}`") if name in df.columns else field_column(df, (spec and spec.path) or ref)
            out[name] = column
    for name in extra:
        out.setdefault(name, F.col(f"`{name}`"))
    return df.select(*[c.alias(n) for n, c in out.items()])


def paged(df: DataFrame, offset: int | None, limit: int | None, default: int | None = DEFAULT_PAGE) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of an ordered DataFrame.

    Giving either bound sets the other to its default (0 and ``default``);
    giving neither returns every row.
    """
    natural_int(offset, "offset")
    natural_int(limit, "limit")
    if offset is None and limit is None:
        return df
    count = default if limit is None else limit
    if offset:
        df = df.offset(offset)
    return df if count is None else df.limit(count)


def sorted_rows(df: DataFrame, sort_by: str | None, sort_order: str | None, key: str) -> DataFrame:
    """Order by a field, or by key, with the key as tie-break."""
    one_of((sort_order or "ASC").upper(), ("ASC", "DESC"), "sort order")
    if sort_by is None:
        return df.orderBy(F.col(f"`{key}`"))
    column = field_column(df, sort_by)
    return df.orderBy(column.desc() if (sort_order or "").upper() == "DESC" else column.asc(), F.col(f"`{key}`"))


def filter_query(
    df: DataFrame,
    where: FilterInput = None,
    fields: Iterable[str] | None = None,
    k: int = DEFAULT_PAGE,
    offset: int | None = None,
    limit: int | None = None,
    sort_by: str | None = None,
    sort_order: str | None = None,
    schema: DocumentSchema | None = None,
) -> DataFrame:
    """Documents that match a filter, one page of them, in key order unless sorted."""
    positive_int(k, "k")
    key = schema.key if schema is not None else "_key"
    page = k if limit is None else limit
    rows = sorted_rows(filtered(df, where, schema), sort_by, sort_order, key)
    return project_fields(paged(rows, offset, page), schema, fields)


def select_where(
    df: DataFrame, where: FilterInput = None, fields: Iterable[str] | None = None, schema: DocumentSchema | None = None
) -> DataFrame:
    """Every document that matches a filter: a filter query without order or page."""
    return project_fields(filtered(df, where, schema), schema, fields)


def count_query(df: DataFrame, where: FilterInput = None, schema: DocumentSchema | None = None) -> DataFrame:
    """One row with the number of matching documents in column ``total``."""
    return filtered(df, where, schema).agg(F.count(F.lit(1)).alias("total"))
