"""Vector columns to and from little-endian bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from ..schema import DATATYPES, normalize_datatype

_NUMPY = {"FLOAT32": "<f4", "FLOAT64": "<f8", "FLOAT16": "<f2", "INT8": "i1", "UINT8": "u1"}
_RANGES = {"INT8": (-128, 127), "UINT8": (0, 255)}


def encode_error(vector: Column, datatype: str = "FLOAT32") -> Column:
    """Why a vector cannot be encoded, null when it can."""
    name = normalize_datatype(datatype)
    doubles = vector.cast("array<double>")
    not_number = F.exists(doubles, lambda v: v.isNull() | F.isnan(v))
    error = F.when(not_number, F.lit("Vector contains non-numeric value"))
    if name in _RANGES:
        low, high = _RANGES[name]
        outside = F.exists(doubles, lambda v: (v != F.floor(v)) | (v < low) | (v > high))
        error = error.when(outside, F.lit(f"Vector value is outside the {name} range ({low} to {high})"))
    return error


def decode_error(data: Column, datatype: str = "FLOAT32") -> Column:
    """Why bytes cannot be decoded, null when they can."""
    name = normalize_datatype(datatype)
    size = DATATYPES[name][0]
    return F.when(
        F.octet_length(data) % size != 0,
        F.concat(
            F.lit("Vector byte length "), F.octet_length(data).cast("string"),
            F.lit(f" is not a multiple of the {name} element size ({size} bytes)"),
        ),
    )


def encoded(vector: Column, datatype: str = "FLOAT32") -> Column:
    """Binary column of a vector column; null where :func:`encode_error` is not."""
    name = normalize_datatype(datatype)
    size = DATATYPES[name][0]

    @F.arrow_udf(T.BinaryType())
    def encode(v: pa.Array) -> pa.Array:
        lengths = v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        offsets = np.concatenate([[0], np.cumsum(lengths)]) * size
        with np.errstate(over="ignore"):
            data = _to_bytes(values, name)
        if offsets[-1] >= 2**31:
            cuts = offsets.tolist()
            return pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())
        buffers = [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.binary(), len(v), buffers)

    usable = vector.isNotNull() & encode_error(vector, name).isNull()
    return F.when(usable, encode(F.when(usable, vector.cast("array<double>"))))


def decoded(data: Column, datatype: str = "FLOAT32") -> Column:
    """Vector column of a binary column; null where :func:`decode_error` is not."""
    name = normalize_datatype(datatype)
    size, element = DATATYPES[name]
    arrow = {T.FloatType(): pa.float32(), T.DoubleType(): pa.float64(), T.ByteType(): pa.int8(), T.ShortType(): pa.int16()}

    @F.arrow_udf(T.ArrayType(element))
    def decode(b: pa.Array) -> pa.Array:
        parts = [x.as_py() or b"" for x in b]
        offsets = np.concatenate([[0], np.cumsum([len(p) // size for p in parts])]).astype(np.int32)
        values = _from_bytes(b"".join(parts), name)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, arrow[element]))

    usable = data.isNotNull() & decode_error(data, name).isNull()
    return F.when(usable, decode(F.when(usable, data)))


def _to_bytes(values: np.ndarray, name: str) -> bytes:
    if name == "BFLOAT16":
        bits = values.astype("<f4").view("<u4").astype(np.uint64)
        return ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16).astype("<u2").tobytes()
    if name == "FLOAT16":
        values = values.astype("<f4")
    elif name in _RANGES:
        values = np.nan_to_num(values).astype(np.int64)
    return values.astype(_NUMPY[name]).tobytes()


def _from_bytes(data: bytes, name: str) -> np.ndarray:
    if name == "BFLOAT16":
        return (np.frombuffer(data, "<u2").astype("<u4") << 16).view("<f4")
    values = np.frombuffer(data, _NUMPY[name])
    return values.astype("<f4") if name == "FLOAT16" else values.astype(np.int16) if name == "UINT8" else values
