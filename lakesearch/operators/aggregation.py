"""Group/reduce aggregation: fluent steps folded into chained DataFrame calls."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any, Union

from pyspark.sql import Column, DataFrame, functions as F

from ..checks import natural_int, one_of, positive_int, text_given, unit_interval
from ..errors import QueryError
from ..functions.predicates import FilterInput, filtered
from ..functions.refs import expression_sql, field_column, reference_name
from ..runtime import ranked
from ..schema import DocumentSchema
from .quantile import exact_quantile

SAMPLE_SEED = 42

SortKey = Union[str, tuple[str, str]]


@dataclass(frozen=True)
class Reducer:
    """One reduction of a group; build it with the functions below."""

    kind: str
    field: str | None = None
    alias: str | None = None
    argument: Any = None
    exact: bool = False

    @property
    def name(self) -> str:
        if self.alias:
            return self.alias
        return self.kind if self.field is None else f"{self.kind}_{reference_name(self.field)}"


def count(alias: str | None = None) -> Reducer:
    return Reducer("count", None, alias)


def count_distinct(field: str, alias: str | None = None) -> Reducer:
    return Reducer("count_distinct", field, alias)


def count_distinctish(field: str, alias: str | None = None, rsd: float = 0.02) -> Reducer:
    """Distinct count by a HyperLogLog++ sketch with relative deviation ``rsd``."""
    return Reducer("count_distinctish", field, alias, rsd)


def sum_(field: str, alias: str | None = None) -> Reducer:
    return Reducer("sum", field, alias)


def min_(field: str, alias: str | None = None) -> Reducer:
    return Reducer("min", field, alias)


def max_(field: str, alias: str | None = None) -> Reducer:
    return Reducer("max", field, alias)


def avg(field: str, alias: str | None = None) -> Reducer:
    return Reducer("avg", field, alias)


def stddev(field: str, alias: str | None = None) -> Reducer:
    """Sample standard deviation."""
    return Reducer("stddev", field, alias)


def quantile(field: str, q: float, alias: str | None = None, exact: bool = False) -> Reducer:
    """Approximate quantile by a bounded sketch, or the exact interpolated one."""
    if q is None:
        raise QueryError("quantile must lie in [0, 1]")
    unit_interval(q, "quantile")
    return Reducer("quantile", field, alias, float(q), exact)


def to_list(field: str, alias: str | None = None) -> Reducer:
    """The distinct values of a group, sorted. The result row holds them all."""
    return Reducer("to_list", field, alias)


def first_value(
    field: str, by: str | None = None, direction: str = "ASC", alias: str | None = None
) -> Reducer:
    """The value in the first row by ``by``; without ``by``, in the row with the smallest key."""
    one_of(direction, ("ASC", "DESC"), "direction")
    return Reducer("first_value", field, alias, (by, direction))


def random_sample(field: str, size: int, alias: str | None = None) -> Reducer:
    """Up to ``size`` values of a group, the same ones on every run."""
    if size is None:
        raise QueryError("random_sample size must be a positive integer")
    positive_int(size, "random_sample size")
    return Reducer("random_sample", field, alias, size)


class Aggregation:
    """Filter a table, then apply the steps in the order they are called.

    Field references may be written ``name``, ``@name`` or ``$.path``; expressions
    are Spark SQL in which ``@name`` stands for a column and ``:name`` for a bound
    parameter. Under ANSI mode ``a / 0`` raises, so use ``try_divide(a, b)``.
    """

    def __init__(self, df: DataFrame, where: FilterInput = None, schema: DocumentSchema | None = None):
        self._df = df
        self._where = where
        self._schema = schema
        self._steps: list[tuple[str, Any]] = []
        self._loads: list[tuple[str, str]] = []
        self._params: dict[str, Any] = {}
        self._scores: dict[str, Any] | None = None
        self._verbatim = False

    def group_by(self, fields: str | Iterable[str], reducers: Reducer | Iterable[Reducer] = ()) -> Aggregation:
        """Group by fields (none for one global group) and reduce each group."""
        names = [fields] if isinstance(fields, str) else list(fields)
        for name in names:
            text_given(name, "group_by field")
            reference_name(name)
        found = [reducers] if isinstance(reducers, Reducer) else list(reducers)
        if not found:
            raise QueryError("group_by requires at least one reducer")
        self._steps.append(("group", (names, found)))
        return self

    def apply(self, expression: str, alias: str) -> Aggregation:
        text_given(expression, "apply expression")
        text_given(alias, "apply alias")
        self._steps.append(("apply", (expression, alias)))
        return self

    def filter(self, expression: str) -> Aggregation:
        text_given(expression, "filter expression")
        self._steps.append(("filter", expression))
        return self

    def sort_by(self, keys: SortKey | Iterable[SortKey], max: int | None = None) -> Aggregation:
        """Sort ascending by default; ``max`` keeps the first rows, 0 keeps all."""
        if isinstance(keys, (str, tuple)):
            keys = [keys]
        pairs = [(k, "ASC") if isinstance(k, str) else (k[0], k[1]) for k in keys]
        if not pairs:
            raise QueryError("sort_by requires at least one field")
        for name, direction in pairs:
            text_given(name, "sort_by field")
            one_of(direction, ("ASC", "DESC"), "sort direction")
        natural_int(max, "sort_by max")
        self._steps.append(("sort", (pairs, max)))
        return self

    def limit(self, offset: int, count: int) -> Aggregation:
        natural_int(offset, "limit offset")
        natural_int(count, "limit count")
        self._steps.append(("limit", (offset, count)))
        return self

    def load(self, fields: str | tuple[str, str] | Iterable[str | tuple[str, str]]) -> Aggregation:
        """Fields of the source rows to return, optionally ``(reference, alias)``; calls add up."""
        if isinstance(fields, (str, tuple)):
            fields = [fields]
        for entry in fields:
            ref, alias = (entry, None) if isinstance(entry, str) else entry
            text_given(ref, "load field")
            if alias is not None:
                text_given(alias, "load alias")
            self._loads.append((ref, alias or reference_name(ref)))
        return self

    def params(self, values: Mapping[str, Any] | None = None, **named: Any) -> Aggregation:
        self._params.update(values or {}, **named)
        return self

    def add_scores(self, text: str, fields: str | Mapping[str, float], **options: Any) -> Aggregation:
        """Start from the documents that match a text query, with their score in ``__score``."""
        self._scores = {"text": text, "fields": fields, **options}
        return self

    def verbatim(self) -> Aggregation:
        """Turn stemming off for the text query."""
        self._verbatim = True
        return self

    def to_df(self) -> DataFrame:
        key = self._schema.key if self._schema is not None else "_key"
        df = self._source()
        kept = [alias for _, alias in self._loads]
        for ref, alias in self._loads:
            if alias not in df.columns or reference_name(ref) != alias or ref.startswith("$."):
                df = df.withColumn(alias, field_column(df, ref))
        if self._scores is not None and kept:
            kept.append("__score")
        unique = [key] if key in df.columns else []
        for kind, step in self._steps:
            if kind == "group":
                names, reducers = step
                df = _reduce_groups(df, names, reducers, key)
                unique, kept = [reference_name(n) for n in names], []
            elif kind == "apply":
                expression, alias = step
                df = self._computed(df, expression, alias)
                if kept:
                    kept.append(alias)
            elif kind == "filter":
                df = self._matching(df, step)
            elif kind == "sort":
                pairs, most = step
                order = [_sort_column(df, name, direction) for name, direction in pairs]
                ties = [F.col(f"`{c}`") for c in unique if c not in {reference_name(n) for n, _ in pairs}]
                df = df.orderBy(*order, *ties)
                df = df.limit(most) if most else df
            else:
                offset, rows = step
                df = (df.offset(offset) if offset else df).limit(rows)
        return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(kept)]) if kept else df

    def _source(self) -> DataFrame:
        if self._scores is not None:
            from .fulltext import text_search

            options = dict(self._scores)
            if self._verbatim:
                options["stem"] = False
            return text_search(
                self._df, schema=self._schema, where=self._where, k=None, alias="__score", **options
            )
        if isinstance(self._where, str) and self._params:
            return self._matching(self._df, self._where)
        return filtered(self._df, self._where, self._schema)

    def _computed(self, df: DataFrame, expression: str, alias: str) -> DataFrame:
        bound = self._bound(expression)
        if bound is None:
            return df.withColumn(alias, F.expr(expression_sql(expression)))
        others = ", ".join(f"`{c}`" for c in df.columns if c != alias)
        return df.sparkSession.sql(
            f"SELECT {others}, ({bound}) AS `{alias}` FROM {{source}}", args=self._params, source=df
        )

    def _matching(self, df: DataFrame, expression: str) -> DataFrame:
        bound = self._bound(expression)
        if bound is None:
            return df.where(F.expr(expression_sql(expression)))
        return df.sparkSession.sql(f"SELECT * FROM {{source}} WHERE {bound}", args=self._params, source=df)

    def _bound(self, expression: str) -> str | None:
        """The expression with ``:name`` markers, or ``None`` if it uses no parameter."""
        if not self._params:
            return None
        text = expression_sql(expression)
        pieces = re.split(r"('(?:[^'\\]|\\.|'')*'|`[^`]*`)", text)
        marked = [
            p if i % 2 else re.sub(r"[$:](\w+)", lambda m: f":{m[1]}" if m[1] in self._params else m[0], p)
            for i, p in enumerate(pieces)
        ]
        joined = "".join(marked)
        used = any(re.search(rf":{re.escape(name)}\b", joined) for name in self._params)
        return joined.replace("{", "{{").replace("}", "}}") if used else None


def _sort_column(df: DataFrame, name: str, direction: str) -> Column:
    column = field_column(df, name)
    return column.desc() if direction == "DESC" else column.asc()


def _reduce_groups(df: DataFrame, names: list[str], reducers: list[Reducer], key: str) -> DataFrame:
    keys = [reference_name(n) for n in names]
    for ref, name in zip(names, keys):
        if name not in df.columns or ref.startswith("$."):
            df = df.withColumn(name, field_column(df, ref))
    # Beside an exact distinct count rows are grouped by value first. A sketch then counts the values
    # that are left, which gives the same, instead of being kept for each of them.
    values: dict[str, str] = {}
    if {"count_distinct", "count_distinctish"} <= {r.kind for r in reducers}:
        for r in reducers:
            if r.kind in ("count_distinct", "count_distinctish") and r.field not in values:
                values[r.field] = f"_value{len(values)}"
        df = df.select("*", *[field_column(df, f).alias(c) for f, c in values.items()])
    if not keys:
        simple = [r for r in reducers if not _needs_own_pass(r)]
        if len(simple) == len(reducers):
            return df.agg(*[_plain(df, r, key, values).alias(r.name) for r in reducers])
        return _reduce_groups(df.drop(*values.values()).withColumn("_all", F.lit(1)), ["_all"], reducers, key).drop("_all")
    quoted = [F.col(f"`{c}`") for c in keys]
    simple = [r for r in reducers if not _needs_own_pass(r)]
    grouped = df.groupBy(*quoted)
    parts = [grouped.agg(*[_plain(df, r, key, values).alias(r.name) for r in simple or [count("_rows")]])]
    # A null group is a group too, but equi-joins drop null keys, so those passes carry a marked key.
    for r in reducers:
        if r in simple:
            continue
        safe = df.withColumn("_group", _group_text(df, quoted))
        if r.kind == "quantile":
            part = exact_quantile(safe, ["_group"], field_column(df, r.field), r.argument, r.name)
        else:
            part = _sampled(safe, r, key)
        parts.append(part)
    if len(parts) > 1:
        parts[0] = parts[0].withColumn("_group", _group_text(parts[0], quoted))
        joined = reduce(lambda a, b: a.join(b, "_group", "left"), parts)
        none = F.array().cast
        return joined.select(
            *quoted,
            *[F.coalesce(f"`{r.name}`", none(joined.schema[r.name].dataType)).alias(r.name) if r.kind == "random_sample" else F.col(f"`{r.name}`") for r in reducers],
        )
    return parts[0]


def _group_text(df: DataFrame, keys: list[Column]) -> Column:
    """A group's keys as one text that is equal where ``groupBy`` holds them equal: -0.0 counts as 0.0."""
    kinds = [t for _, t in df.select(*keys).dtypes]
    return F.to_json(F.struct(*[k + F.lit(0.0).cast(t) if t in ("double", "float") else k for k, t in zip(keys, kinds)]))


def _needs_own_pass(r: Reducer) -> bool:
    return r.kind == "random_sample" or (r.kind == "quantile" and r.exact)


def _plain(df: DataFrame, r: Reducer, key: str, values: dict[str, str]) -> Column:
    if r.kind == "count":
        return F.count(F.lit(1))
    if r.field in values and r.kind == "count_distinct":
        return F.count_distinct(values[r.field])
    if r.field in values and r.kind == "count_distinctish":
        return F.expr(f"approx_count_distinct(DISTINCT {values[r.field]}, {float(r.argument)}D)")
    value = field_column(df, r.field)
    if r.kind == "count_distinct":
        return F.count_distinct(value)
    if r.kind == "count_distinctish":
        return F.approx_count_distinct(value, r.argument)
    if r.kind == "quantile":
        return F.percentile_approx(value, F.lit(r.argument), F.lit(10000))
    if r.kind == "to_list":
        return F.array_sort(F.collect_set(value))
    if r.kind == "first_value":
        by, direction = r.argument
        tie = F.col(f"`{key}`") if key in df.columns else value
        if by is None:
            return F.min_by(value, tie)
        order = field_column(df, by)
        if direction == "ASC":
            return F.min_by(value, F.struct(order.isNull(), order, tie))
        return F.max_by(value, F.struct(order.isNotNull(), order, tie))
    simple = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "stddev": F.stddev_samp}
    return simple[r.kind](value)


def _sampled(df: DataFrame, r: Reducer, key: str) -> DataFrame:
    """Rows with the smallest seeded hashes; each partition trims its groups before the shuffle."""
    unit = [F.col(f"`{key}`")] if key in df.columns else [F.col(f"`{c}`") for c in df.columns]
    draw = df.select("_group", field_column(df, r.field).alias("_v"), F.xxhash64(*unit, F.lit(SAMPLE_SEED)).alias("_h"))
    draw = draw.where(F.col("_v").isNotNull())
    kept = ranked(draw, ["_group"], [F.col("_h"), F.col("_v")], r.argument, "_r")
    pairs = F.array_sort(F.collect_list(F.struct("_r", "_v")))
    return kept.groupBy("_group").agg(F.transform(pairs, lambda p: p["_v"]).alias(r.name))
