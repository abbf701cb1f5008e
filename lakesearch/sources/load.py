"""Bulk load: preprocess, assign keys, validate, stamp expiry, upsert."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..checks import natural_number, one_of
from ..errors import SchemaError
from ..functions.validation import errors_column
from ..runtime import written
from ..schema import DocumentSchema
from .collection import EXPIRY, Collection

VALIDATION = ("off", "fail", "quarantine")
_SAMPLE = 5


@dataclass(frozen=True)
class LoadResult:
    """What a load did: the source and number of its batch, the keys written, and the rejected rows."""

    batch: tuple[str, int]
    keys: DataFrame
    rejected: DataFrame | None = None


def with_keys(
    df: DataFrame, schema: DocumentSchema, id_field: str | None = None, keys: str | None = None
) -> DataFrame:
    """Add the document key: an explicit key column verbatim, else prefix and id, else a generated id."""
    if keys is not None:
        if keys not in df.columns:
            raise SchemaError(f"Key column '{keys}' not found in the documents")
        value: Column = F.col(f"`{keys}`").cast("string")
    elif id_field is not None:
        if id_field not in df.columns:
            raise SchemaError(f"Key field '{id_field}' not found in the documents")
        value = schema.key_column(F.col(f"`{id_field}`"))
    else:
        value = schema.key_column(F.expr("uuid()"))
    return df.withColumn(schema.key, value)


def split_valid(df: DataFrame, schema: DocumentSchema) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the schema, and the others with their messages in ``_errors``."""
    checked = df.withColumn("_errors", errors_column(df, schema))
    return checked.where(F.size("_errors") == 0).drop("_errors"), checked.where(F.size("_errors") > 0)


def with_expiry(df: DataFrame, ttl: float | None, now: Column | None = None) -> DataFrame:
    """Stamp the expiry time; without ``ttl``, or with 0, rows never expire."""
    natural_number(ttl, "ttl")
    moment = now if now is not None else F.current_timestamp()
    stamp = moment + F.make_dt_interval(secs=F.lit(float(ttl))) if ttl else F.lit(None)
    return df.withColumn(EXPIRY, stamp.cast("timestamp"))


def load(
    df: DataFrame,
    target: Collection,
    id_field: str | None = None,
    keys: str | None = None,
    ttl: float | None = None,
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
    validate: str = "off",
    mode: str | None = None,
    order: str | None = None,
    now: Column | None = None,
    batch: tuple[str, int] | None = None,
) -> LoadResult:
    """Load documents into a collection.

    ``fail`` writes nothing when any row is wrong; ``quarantine`` writes the valid rows
    and returns the others. ``preprocess`` is a DataFrame transformation that runs
    before validation.
    """
    one_of(validate, VALIDATION, "validate")
    schema = target.schema
    rows = with_keys(df, schema, id_field, keys)
    if preprocess is not None:
        rows = preprocess(rows)
    if preprocess is not None or (keys is None and id_field is None):
        # Costly preprocessing runs once, and generated keys stay the same, in the passes that follow.
        rows = written(rows, "prepared")
    rejected = None
    if validate != "off":
        valid, wrong = split_valid(rows, schema)
        if validate == "fail":
            sample = wrong.select(schema.key, "_errors").limit(_SAMPLE).collect()
            if sample:
                lines = "; ".join(f"{r[0]}: {', '.join(r[1])}" for r in sample)
                raise SchemaError(f"Documents do not match schema '{schema.name}': {lines}")
        rows, rejected = valid, wrong
    rows = with_expiry(rows, ttl, now)
    written_as = target.upsert(rows, mode, order, batch)
    return LoadResult(written_as, rows.select(schema.key), rejected)
