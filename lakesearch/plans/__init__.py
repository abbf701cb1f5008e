"""Reports over the given tables: one or more per operator, most with an SQL twin."""

from __future__ import annotations

from importlib import import_module

from .tables import Report

_FAMILIES = ("filters", "vectors", "texts", "hybrids", "aggregates", "loads", "streams")


def all_reports() -> dict[str, Report]:
    out: dict[str, Report] = {}
    for family in _FAMILIES:
        out.update(import_module(f".{family}", __name__).REPORTS)
    return out
