"""The given tables and the document schemas the reports below read them with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schema import DocumentSchema

DIMS = 64


@dataclass(frozen=True)
class Report:
    """A named DataFrame over the given tables, and the SQL that must agree with it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _vector(metric: str) -> dict:
    return {"name": "embedding", "type": "vector", "attrs": {"algorithm": "flat", "dims": DIMS, "metric": metric}}


def embeddings_schema(metric: str = "COSINE") -> DocumentSchema:
    return DocumentSchema("embeddings", [_vector(metric), {"name": "label", "type": "numeric"}], key="vec_id")


EMBEDDINGS = embeddings_schema()
_SINGLE = {"single_valued": True, "case_sensitive": True}
PART = DocumentSchema(
    "part",
    [
        {"name": "p_brand", "type": "tag", "attrs": _SINGLE},
        {"name": "p_type", "type": "tag", "attrs": _SINGLE},
        {"name": "p_size", "type": "numeric"},
        {"name": "p_retailprice", "type": "numeric"},
    ],
    key="p_partkey",
)
EVENTS = DocumentSchema(
    "events",
    [{"name": "event_type", "type": "tag", "attrs": _SINGLE}, {"name": "value", "type": "numeric"}],
    key="event_id",
)
DOCUMENTS = DocumentSchema(
    "documents",
    [
        {"name": "text", "type": "text"},
        {"name": "lang", "type": "tag", "attrs": _SINGLE},
        {"name": "source", "type": "tag", "attrs": _SINGLE},
        {"name": "tags", "type": "tag"},
        {"name": "n_chars", "type": "numeric"},
    ],
    key="doc_id",
)
PAGES = DocumentSchema("pages", [{"name": "url", "type": "text"}, {"name": "html", "type": "text"}], key="page_id")
CUSTOMERS = DocumentSchema(
    "customer", [{"name": "c_mktsegment", "type": "tag"}, {"name": "geo", "type": "geo"}], key="c_custkey"
)
ORDERS = DocumentSchema("orders", [{"name": "o_totalprice", "type": "numeric"}], key="o_orderkey")
MIXED = DocumentSchema(
    "mixed",
    [{"name": "text", "type": "text"}, {"name": "lang", "type": "tag", "attrs": _SINGLE}, _vector("COSINE")],
    key="doc_id",
)
