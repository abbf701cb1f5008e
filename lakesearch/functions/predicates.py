"""Typed predicates over tag, numeric, text, geo and timestamp fields.

A predicate turns into one Spark ``Column`` when it meets a table. ``&`` and
``|`` (or ``and_``/``or_``) compose predicates; a predicate that matches
everything is neutral for both, so ``everything | x`` is ``x``.

Positive operators never match a null; every ``ne`` does, because a document
without the field does not hold the unwanted value.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from numbers import Real
from typing import Union

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..checks import natural_int, natural_number, one_of
from ..errors import QueryError
from ..schema import DocumentSchema, Field
from .refs import expression_sql, field_column, path_column
from .text import literal_tokens, phrase_match, tokens

Builder = Callable[[DataFrame, "DocumentSchema | None"], Column]

INCLUSIVE_MODES = ("both", "neither", "left", "right")

# Metres per unit and the Earth radius in metres.
METRES = {"m": 1.0, "km": 1000.0, "mi": 1609.34, "ft": 0.3048}
EARTH_RADIUS = 6372797.560856


class Predicate:
    """A condition on documents, built into a ``Column`` by :meth:`column`."""

    def __init__(self, build: Builder | None = None):
        self._build = build

    @property
    def matches_all(self) -> bool:
        return self._build is None

    def column(self, df: DataFrame, schema: DocumentSchema | None = None) -> Column | None:
        """The condition for ``df``; ``None`` when everything matches."""
        return None if self._build is None else self._build(df, schema)

    def and_(self, other: Predicate) -> Predicate:
        return _combine(self, other, lambda a, b: a & b)

    def or_(self, other: Predicate) -> Predicate:
        return _combine(self, other, lambda a, b: a | b)

    __and__ = and_
    __or__ = or_


MATCH_ALL = Predicate()

FilterInput = Union[Predicate, Column, str, None]


def _combine(left: Predicate, right: Predicate, op: Callable[[Column, Column], Column]) -> Predicate:
    if left.matches_all:
        return right
    if right.matches_all:
        return left
    return Predicate(lambda df, schema: op(left.column(df, schema), right.column(df, schema)))


def filter_column(where: FilterInput, df: DataFrame, schema: DocumentSchema | None = None) -> Column | None:
    """A filter given as predicate, ``Column`` or Spark SQL text as a ``Column``."""
    if where is None or (isinstance(where, str) and where.strip() in ("", "*")):
        return None
    if isinstance(where, Predicate):
        return where.column(df, schema)
    return F.expr(expression_sql(where)) if isinstance(where, str) else where


def filtered(df: DataFrame, where: FilterInput, schema: DocumentSchema | None = None) -> DataFrame:
    condition = filter_column(where, df, schema)
    return df if condition is None else df.where(condition)


def _not(match: Column) -> Column:
    return ~F.coalesce(match, F.lit(False))


@dataclass(frozen=True)
class _FieldRef:
    name: str

    def _spec(self, schema: DocumentSchema | None) -> Field | None:
        return schema.field(self.name) if schema is not None else None

    def _column(self, df: DataFrame, schema: DocumentSchema | None) -> Column:
        spec = self._spec(schema)
        if spec is None:
            return field_column(df, self.name)
        if spec.path and spec.alias not in df.columns:
            return path_column(df, spec.path).cast(spec.spark_type())
        return F.col(f"`{spec.alias}`")

    def _type(self, df: DataFrame, schema: DocumentSchema | None) -> T.DataType:
        return df.select(self._column(df, schema)).schema[0].dataType

    def is_missing(self) -> Predicate:
        return Predicate(lambda df, schema: self._column(df, schema).isNull())


class Tag(_FieldRef):
    """Exact matching on a tag field.

    A tag column holds one string of separated tags or an array of tags. Matching
    ignores case unless the field is declared ``case_sensitive``. A field declared
    ``single_valued`` and ``case_sensitive`` compares the plain column, which the
    scan can push down.
    """

    def eq(self, value: str | Iterable[str]) -> Predicate:
        values = _as_list(value)
        return Predicate(lambda df, schema: self._any_of(df, schema, values)) if values else MATCH_ALL

    def ne(self, value: str | Iterable[str]) -> Predicate:
        values = _as_list(value)
        return Predicate(lambda df, schema: _not(self._any_of(df, schema, values))) if values else MATCH_ALL

    def like(self, pattern: str | Iterable[str]) -> Predicate:
        patterns = _as_list(pattern)
        return Predicate(lambda df, schema: self._like(df, schema, patterns)) if patterns else MATCH_ALL

    def _attr(self, schema: DocumentSchema | None, name: str, default):
        spec = self._spec(schema)
        return default if spec is None else spec.attrs.get(name, default)

    def _plain(self, df: DataFrame, schema: DocumentSchema | None) -> bool:
        return bool(
            self._attr(schema, "single_valued", False)
            and self._attr(schema, "case_sensitive", False)
            and isinstance(self._type(df, schema), T.StringType)
        )

    def _tags(self, df: DataFrame, schema: DocumentSchema | None) -> tuple[Column, Callable[[str], str]]:
        column = self._column(df, schema)
        if not isinstance(self._type(df, schema), T.ArrayType):
            if self._attr(schema, "single_valued", False):
                column = F.array(column)
            else:
                separator = self._attr(schema, "separator", ",")
                column = F.split(column, re.escape(separator))
        if self._attr(schema, "case_sensitive", False):
            return F.transform(column, F.trim), str.strip
        return F.transform(column, lambda t: F.lower(F.trim(t))), lambda v: v.strip().lower()

    def _any_of(self, df: DataFrame, schema: DocumentSchema | None, values: list[str]) -> Column:
        if self._plain(df, schema):
            return self._column(df, schema).isin(*values)
        tags, norm = self._tags(df, schema)
        return F.arrays_overlap(tags, F.array(*[F.lit(norm(v)) for v in values]))

    def _like(self, df: DataFrame, schema: DocumentSchema | None, patterns: list[str]) -> Column:
        if self._plain(df, schema):
            column = self._column(df, schema)
            return reduce(lambda a, b: a | b, [_wildcard(column, p) for p in patterns])
        tags, norm = self._tags(df, schema)
        return F.exists(tags, lambda t: reduce(lambda a, b: a | b, [_wildcard(t, norm(p)) for p in patterns]))


class Num(_FieldRef):
    """Comparisons on a numeric field."""

    def eq(self, value: Real) -> Predicate:
        return self._compare(lambda c: c == value)

    def ne(self, value: Real) -> Predicate:
        return self._compare(lambda c: _not(c == value))

    def gt(self, value: Real) -> Predicate:
        return self._compare(lambda c: c > value)

    def lt(self, value: Real) -> Predicate:
        return self._compare(lambda c: c < value)

    def ge(self, value: Real) -> Predicate:
        return self._compare(lambda c: c >= value)

    def le(self, value: Real) -> Predicate:
        return self._compare(lambda c: c <= value)

    def between(self, low: Real, high: Real, inclusive: str = "both") -> Predicate:
        one_of(inclusive, INCLUSIVE_MODES, "inclusive")
        return self._compare(
            lambda c: ((c >= low) if inclusive in ("both", "left") else (c > low))
            & ((c <= high) if inclusive in ("both", "right") else (c < high))
        )

    def _compare(self, test: Callable[[Column], Column]) -> Predicate:
        return Predicate(lambda df, schema: test(self._column(df, schema)))


class Text(_FieldRef):
    """Phrase, prefix, wildcard and fuzzy matching on the tokens of a text field."""

    def eq(self, phrase: str) -> Predicate:
        words = literal_tokens(phrase)
        return self._tokens(lambda t: phrase_match(t, words))

    def ne(self, phrase: str) -> Predicate:
        words = literal_tokens(phrase)
        return self._tokens(lambda t: _not(phrase_match(t, words)))

    def prefix(self, start: str) -> Predicate:
        return self._tokens(lambda t: F.exists(t, lambda w: w.startswith(start.lower())))

    def wildcard(self, pattern: str) -> Predicate:
        return self._tokens(lambda t: F.exists(t, lambda w: _wildcard(w, pattern.lower())))

    def fuzzy(self, word: str, distance: int = 1) -> Predicate:
        natural_int(distance, "distance")
        target = word.lower()
        return self._tokens(lambda t: F.exists(t, lambda w: F.levenshtein(w, F.lit(target), distance) >= 0))

    def any_of(self, *phrases: str) -> Predicate:
        found = [literal_tokens(p) for p in phrases]
        return self._tokens(lambda t: reduce(lambda a, b: a | b, [phrase_match(t, p) for p in found]))

    def like(self, pattern: str) -> Predicate:
        """``x*``, ``*x``, ``a?c``, ``%x%`` (fuzzy, one edit per percent sign) or ``a|b``."""
        alternatives = [p.strip() for p in pattern.split("|") if p.strip()]
        if not alternatives:
            raise QueryError("like needs a pattern")
        return reduce(Predicate.or_, [self._like_one(p) for p in alternatives])

    def _like_one(self, pattern: str) -> Predicate:
        edits = len(pattern) - len(pattern.lstrip("%"))
        if edits and pattern.endswith("%" * edits):
            return self.fuzzy(pattern.strip("%"), edits)
        if pattern.endswith("*") and not re.search(r"[*?]", pattern[:-1]):
            return self.prefix(pattern[:-1])
        return self.wildcard(pattern) if re.search(r"[*?]", pattern) else self.eq(pattern)

    def _tokens(self, test: Callable[[Column], Column]) -> Predicate:
        return Predicate(lambda df, schema: test(tokens(self._column(df, schema))))


@dataclass(frozen=True)
class GeoRadius:
    """A circle on the globe: centre, radius and unit (m, km, mi or ft)."""

    longitude: float
    latitude: float
    radius: float = 1.0
    unit: str = "km"

    def __post_init__(self) -> None:
        one_of(str(self.unit).lower(), METRES, "geo unit")
        natural_number(self.radius, "radius")

    @property
    def metres(self) -> float:
        return self.radius * METRES[self.unit.lower()]


class Geo(_FieldRef):
    """Radius tests on a geo field: a ``lon,lat`` string or a ``struct<lon,lat>``."""

    def eq(self, circle: GeoRadius) -> Predicate:
        return Predicate(lambda df, schema: self._inside(df, schema, circle))

    def ne(self, circle: GeoRadius) -> Predicate:
        return Predicate(lambda df, schema: _not(self._inside(df, schema, circle)))

    def _inside(self, df: DataFrame, schema: DocumentSchema | None, circle: GeoRadius) -> Column:
        column = self._column(df, schema)
        if isinstance(self._type(df, schema), T.StructType):
            lon, lat = column["lon"], column["lat"]
        else:
            lon, lat = geo_point(column)
        box = _bounding_box(lon, lat, circle)
        near = great_circle(lon, lat, circle.longitude, circle.latitude) <= circle.metres
        return near if box is None else box & near


def geo_point(text: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a ``lon,lat`` string; null where it is malformed."""
    parts = F.split(F.trim(text), ",")
    whole = F.size(parts) == 2

    def number(i: int) -> Column:
        return F.when(whole, F.trim(F.get(parts, F.lit(i))).try_cast("double"))

    return number(0), number(1)


def great_circle(lon: Column, lat: Column, lon0: float, lat0: float) -> Column:
    """Haversine distance in metres to a fixed point."""
    dlat = F.radians(lat - lat0) / 2
    dlon = F.radians(lon - lon0) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat)) * math.cos(math.radians(lat0)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.when(h > 1.0, F.lit(1.0)).otherwise(h)))


def _bounding_box(lon: Column, lat: Column, circle: GeoRadius) -> Column | None:
    """A cheap enclosing box, a little wider than the circle; ``None`` if it spans the globe."""
    angle = circle.metres / EARTH_RADIUS * (1 + 1e-9) + 1e-12
    if angle >= math.pi:
        return None
    spread = math.degrees(angle)
    low, high = circle.latitude - spread, circle.latitude + spread
    box = (lat >= max(low, -90.0)) & (lat <= min(high, 90.0))
    if low <= -90 or high >= 90:
        return box
    width = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(circle.latitude))))) + 1e-9
    west, east = circle.longitude - width, circle.longitude + width
    if west < -180:
        return box & ((lon >= west + 360) | (lon <= east))
    if east > 180:
        return box & ((lon >= west) | (lon <= east - 360))
    return box & (lon >= west) & (lon <= east)


Instant = Union[datetime, date, str, int, float]

_DATE_ONLY = re.compile(r"\d{4}-\d{2}-\d{2}")
_LAST_SECOND = 86399


class Timestamp(_FieldRef):
    """Instant tests at whole seconds on a timestamp column or epoch-second column.

    An ISO date without time stands for its UTC day in ``eq``, ``ne`` and the upper
    bound of ``between``; everywhere else it stands for the first second of the day.
    """

    def eq(self, value: Instant) -> Predicate:
        if _is_date_only(value):
            return self.between(value, value)
        second = _epoch(value)
        return self._compare(lambda c: c.eq(second))

    def ne(self, value: Instant) -> Predicate:
        positive = self.eq(value)
        return Predicate(lambda df, schema: _not(positive.column(df, schema)))

    def gt(self, value: Instant) -> Predicate:
        second = _epoch(value)
        return self._compare(lambda c: c.gt(second))

    def lt(self, value: Instant) -> Predicate:
        second = _epoch(value)
        return self._compare(lambda c: c.lt(second))

    def ge(self, value: Instant) -> Predicate:
        second = _epoch(value)
        return self._compare(lambda c: c.ge(second))

    def le(self, value: Instant) -> Predicate:
        second = _epoch(value)
        return self._compare(lambda c: c.le(second))

    def between(self, start: Instant, end: Instant, inclusive: str = "both") -> Predicate:
        one_of(inclusive, INCLUSIVE_MODES, "inclusive")
        low, high = _epoch(start), _epoch(end, day_end=True)
        return self._compare(
            lambda c: (c.ge(low) if inclusive in ("both", "left") else c.gt(low))
            & (c.le(high) if inclusive in ("both", "right") else c.lt(high))
        )

    def _compare(self, test: Callable[["_Seconds"], Column]) -> Predicate:
        return Predicate(
            lambda df, schema: test(_Seconds(self._column(df, schema), self._type(df, schema)))
        )


class _Seconds:
    """Second-resolution comparisons that stay plain column-against-literal tests."""

    def __init__(self, column: Column, dtype: T.DataType):
        self.column = column.cast("timestamp_ntz") if isinstance(dtype, T.DateType) else column
        self.numeric = isinstance(dtype, T.NumericType)
        self.naive = isinstance(dtype, (T.TimestampNTZType, T.DateType))

    def _at(self, second: int) -> Column:
        if self.naive:
            moment = datetime(1970, 1, 1) + timedelta(seconds=second)
            return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S}'")
        return F.timestamp_seconds(F.lit(second))

    def eq(self, s: float) -> Column:
        if self.numeric:
            return self.column == s
        if s != math.floor(s):
            return F.lit(False)
        return (self.column >= self._at(int(s))) & (self.column < self._at(int(s) + 1))

    def gt(self, s: float) -> Column:
        return self.column > s if self.numeric else self.column >= self._at(math.floor(s) + 1)

    def ge(self, s: float) -> Column:
        return self.column >= s if self.numeric else self.column >= self._at(math.ceil(s))

    def lt(self, s: float) -> Column:
        return self.column < s if self.numeric else self.column < self._at(math.ceil(s))

    def le(self, s: float) -> Column:
        return self.column <= s if self.numeric else self.column < self._at(math.floor(s) + 1)


def _is_date_only(value: Instant) -> bool:
    return isinstance(value, str) and _DATE_ONLY.fullmatch(value) is not None


def _epoch(value: Instant, day_end: bool = False) -> float:
    """Epoch seconds of an instant; fractions of text and datetime inputs are dropped."""
    if isinstance(value, Real) and not isinstance(value, bool):
        return value
    if isinstance(value, str):
        try:
            moment = datetime.fromisoformat(value)
        except ValueError as error:
            raise QueryError(f"{value!r} is no ISO date or time") from error
        extra = _LAST_SECOND if day_end and _is_date_only(value) else 0
    elif isinstance(value, datetime):
        moment, extra = value, 0
    elif isinstance(value, date):
        moment, extra = datetime(value.year, value.month, value.day), 0
    else:
        raise QueryError(f"A point in time is a datetime, an ISO string or a number of seconds, not {type(value).__name__}")
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return math.floor(moment.timestamp()) + extra


def _as_list(value: str | Iterable[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _wildcard(column: Column, pattern: str) -> Column:
    """``*`` and ``?`` matching of a whole string."""
    if pattern.endswith("*") and not re.search(r"[*?]", pattern[:-1]):
        return column.startswith(pattern[:-1])
    body = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern)
    return column.rlike(f"(?s)^{body}$")
