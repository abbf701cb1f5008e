"""Argument checks shared by the query functions."""

from __future__ import annotations

import math
from collections.abc import Iterable
from numbers import Integral, Real
from typing import Any

from .errors import QueryError


def positive_int(value: Any, label: str) -> None:
    if value is not None and (not isinstance(value, Integral) or isinstance(value, bool) or value <= 0):
        raise QueryError(f"{label} must be a positive integer, got {value!r}")


def natural_int(value: Any, label: str) -> None:
    if value is not None and (not isinstance(value, Integral) or isinstance(value, bool) or value < 0):
        raise QueryError(f"{label} must be a non-negative integer, got {value!r}")


def natural_number(value: Any, label: str) -> None:
    if value is not None and (not _finite(value) or value < 0):
        raise QueryError(f"{label} must be a non-negative number, got {value!r}")


def unit_interval(value: Any, label: str) -> None:
    if value is not None and (not _finite(value) or not 0 <= value <= 1):
        raise QueryError(f"{label} must lie in [0, 1], got {value!r}")


def text_given(value: Any, label: str) -> None:
    if not isinstance(value, str) or not value.strip():
        raise QueryError(f"{label} cannot be empty")


def one_of(value: Any, allowed: Iterable[str], label: str) -> None:
    allowed = tuple(allowed)
    if value not in allowed:
        raise QueryError(f"{label} must be one of {', '.join(allowed)}; got {value!r}")


def _finite(value: Any) -> bool:
    return isinstance(value, Real) and not isinstance(value, bool) and math.isfinite(value)


finite = _finite
