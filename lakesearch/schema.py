"""Document schemas: which columns of a table play which search role.

The role of a column (text, tag, numeric, geo or vector) and its attributes
travel in ``StructField.metadata``, so a schema survives a Parquet round trip
and can be read back from any DataFrame that was annotated with it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field as dataclass_field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .errors import SchemaError

ROLES = ("text", "tag", "numeric", "geo", "vector")
METRICS = ("COSINE", "L2", "IP")
ALGORITHMS = ("flat", "hnsw")
STORAGE_KINDS = ("hash", "json")

# Bytes of one vector element and the Spark type that holds it.
DATATYPES: dict[str, tuple[int, T.DataType]] = {
    "BFLOAT16": (2, T.FloatType()),
    "FLOAT16": (2, T.FloatType()),
    "FLOAT32": (4, T.FloatType()),
    "FLOAT64": (8, T.DoubleType()),
    "INT8": (1, T.ByteType()),
    "UINT8": (1, T.ShortType()),
}

_METADATA_KEY = "lakesearch"


def normalize_datatype(datatype: str | None) -> str:
    name = str(datatype or "FLOAT32").upper()
    if name not in DATATYPES:
        raise SchemaError(f"Invalid vector datatype {datatype!r}; use one of {', '.join(DATATYPES)}")
    return name


def normalize_metric(metric: str | None) -> str:
    name = str(metric or "COSINE").upper()
    if name not in METRICS:
        raise SchemaError(f"Invalid distance metric {metric!r}; use one of {', '.join(METRICS)}")
    return name


@dataclass(frozen=True)
class Field:
    """One searchable field: a column, its role and the role's attributes.

    ``path`` names a nested value (``$.a.b``); the field is then read through
    the path and exposed under ``alias``.
    """

    name: str
    role: str
    attrs: Mapping[str, Any] = dataclass_field(default_factory=dict)
    path: str | None = None

    def __post_init__(self) -> None:
        if not self.name:
            raise SchemaError("A field needs a name")
        if self.role not in ROLES:
            raise SchemaError(f"A field cannot have the type {self.role!r}")
        attrs = dict(self.attrs or {})
        if self.role == "tag":
            attrs.setdefault("separator", ",")
        if self.role == "vector":
            if not attrs.get("algorithm"):
                raise SchemaError(f"Vector field '{self.name}' must provide an algorithm")
            if attrs.get("dims") is None:
                raise SchemaError(f"Vector field '{self.name}' must provide dims")
            attrs["algorithm"] = str(attrs["algorithm"]).lower()
            if attrs["algorithm"] not in ALGORITHMS:
                raise SchemaError(f"No vector index is called {attrs['algorithm']!r}")
            attrs["metric"] = normalize_metric(attrs.pop("distance_metric", attrs.get("metric")))
            attrs["datatype"] = normalize_datatype(attrs.get("datatype"))
        object.__setattr__(self, "attrs", attrs)

    @property
    def alias(self) -> str:
        if self.attrs.get("as"):
            return self.attrs["as"]
        return self.name[2:].replace(".", "_") if self.name.startswith("$.") else self.name

    @property
    def dims(self) -> int | None:
        return self.attrs.get("dims")

    @property
    def metric(self) -> str:
        return self.attrs.get("metric", "COSINE")

    @property
    def datatype(self) -> str:
        return self.attrs.get("datatype", "FLOAT32")

    def spark_type(self) -> T.DataType:
        if self.role == "vector":
            return T.ArrayType(DATATYPES[self.datatype][1])
        return T.DoubleType() if self.role == "numeric" else T.StringType()


class DocumentSchema:
    """The declared shape of one document collection.

    ``key`` is the column that identifies a document; collections written by
    :func:`lakesearch.load` use ``_key``, other tables may name any unique column.
    """

    def __init__(
        self,
        name: str,
        fields: Iterable[Field | Mapping[str, Any]] = (),
        prefix: str | Iterable[str] = "doc",
        key_separator: str = ":",
        storage: str = "hash",
        stopwords: Iterable[str] | None = None,
        key: str = "_key",
    ):
        if not name:
            raise SchemaError("A schema needs a non-empty name")
        if storage not in STORAGE_KINDS:
            raise SchemaError(f"storage must be one of {', '.join(STORAGE_KINDS)}, got {storage!r}")
        self.name = name
        self.prefixes = [prefix] if isinstance(prefix, str) else list(prefix)
        self.key_separator = key_separator
        self.storage = storage
        self.stopwords = None if stopwords is None else list(stopwords)
        self.key = key
        self.fields: dict[str, Field] = {}
        self.add_fields(fields)

    @property
    def field_names(self) -> list[str]:
        return list(self.fields)

    def add_field(self, spec: Field | Mapping[str, Any]) -> DocumentSchema:
        if not isinstance(spec, Field):
            role = spec.get("type") or spec.get("role")
            if not spec.get("name"):
                raise SchemaError("A field needs a name")
            if not role:
                raise SchemaError(f"Field '{spec['name']}' needs a type")
            spec = Field(spec["name"], role, spec.get("attrs") or {}, spec.get("path"))
        if spec.name in self.fields:
            raise SchemaError(f"Two fields are called {spec.name!r}")
        if self.storage == "json":
            path = spec.path or (spec.name if spec.name.startswith("$.") else f"$.{spec.name}")
            spec = Field(spec.name, spec.role, spec.attrs, path)
        elif spec.path is not None:
            spec = Field(spec.name, spec.role, spec.attrs, None)
        self.fields[spec.name] = spec
        return self

    def add_fields(self, specs: Iterable[Field | Mapping[str, Any]]) -> DocumentSchema:
        for spec in specs:
            self.add_field(spec)
        return self

    def remove_field(self, name: str) -> DocumentSchema:
        self.fields.pop(name, None)
        return self

    def field(self, name: str) -> Field | None:
        """The field declared as ``name`` or exposed under that alias."""
        if name in self.fields:
            return self.fields[name]
        return next((f for f in self.fields.values() if f.alias == name), None)

    def of_role(self, role: str) -> list[Field]:
        return [f for f in self.fields.values() if f.role == role]

    # -- plain objects ---------------------------------------------------

    @classmethod
    def from_dict(cls, data: Mapping[str, Any]) -> DocumentSchema:
        index = {_snake(k): v for k, v in data["index"].items()}
        specs = data.get("fields") or []
        if isinstance(specs, Mapping):
            for name, spec in specs.items():
                if spec.get("name") != name:
                    raise SchemaError(f"The field under {name!r} calls itself {spec.get('name')!r}")
            specs = list(specs.values())
        specs = [
            {**spec, "attrs": {_snake(k): v for k, v in (spec.get("attrs") or {}).items()}} for spec in specs
        ]
        return cls(
            name=index.get("name", ""),
            fields=specs,
            prefix=index.get("prefix", "doc"),
            key_separator=index.get("key_separator", ":"),
            storage=index.get("storage_type", index.get("storage", "hash")),
            stopwords=index.get("stopwords"),
            key=index.get("key", "_key"),
        )

    def to_dict(self) -> dict[str, Any]:
        index: dict[str, Any] = {
            "name": self.name,
            "prefix": self.prefixes[0] if len(self.prefixes) == 1 else list(self.prefixes),
            "key_separator": self.key_separator,
            "storage_type": self.storage,
            "key": self.key,
        }
        if self.stopwords is not None:
            index["stopwords"] = list(self.stopwords)
        fields = []
        for spec in self.fields.values():
            entry: dict[str, Any] = {"name": spec.name, "type": spec.role}
            if spec.attrs:
                entry["attrs"] = dict(spec.attrs)
            if spec.path is not None:
                entry["path"] = spec.path
            fields.append(entry)
        return {"index": index, "fields": fields}

    # -- Spark -------------------------------------------------------------

    def struct_type(self) -> T.StructType:
        """The schema as a ``StructType`` whose metadata carries the roles."""
        return T.StructType(
            [T.StructField(self.key, T.StringType(), False)]
            + [
                T.StructField(f.alias, f.spark_type(), True, {_METADATA_KEY: json.dumps(_field_dict(f))})
                for f in self.fields.values()
            ]
        )

    def annotate(self, df: DataFrame) -> DataFrame:
        """Attach every declared field's role to the matching column of ``df``."""
        for spec in self.fields.values():
            if spec.alias in df.columns:
                df = df.withMetadata(spec.alias, {_METADATA_KEY: json.dumps(_field_dict(spec))})
        return df

    @classmethod
    def from_frame(cls, df: DataFrame, name: str, **options: Any) -> DocumentSchema:
        """Rebuild a schema from the metadata :meth:`annotate` left on ``df``."""
        specs = [
            json.loads(f.metadata[_METADATA_KEY]) for f in df.schema.fields if _METADATA_KEY in f.metadata
        ]
        return cls(name, specs, **options)

    def project(self, df: DataFrame) -> DataFrame:
        """Add a top-level column for every field that is read through a path."""
        from .functions.refs import path_column

        for spec in self.fields.values():
            if spec.path and spec.alias not in df.columns:
                df = df.withColumn(spec.alias, path_column(df, spec.path).cast(spec.spark_type()))
        return df

    def key_column(self, value: Column) -> Column:
        """``prefix + separator + id`` with trailing separators of the prefix removed."""
        prefix = self.prefixes[0] if self.prefixes else ""
        separator = self.key_separator
        if separator:
            while prefix.endswith(separator):
                prefix = prefix[: -len(separator)]
        value = value.cast("string")
        return F.concat(F.lit(prefix + separator), value) if prefix else value


def _field_dict(spec: Field) -> dict[str, Any]:
    return {"name": spec.alias, "type": spec.role, "attrs": dict(spec.attrs)}


def _snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)
