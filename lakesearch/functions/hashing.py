"""Locality-sensitive hashes of vector columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from ..checks import positive_int
from ..errors import QueryError
from .distance import vector_matrix

_BAND_BITS = 10
# Projections held at a time.
_PROJECTIONS = 500_000


@dataclass(frozen=True)
class Bands:
    """``bands`` hashes of ``bits`` projections each, repeatable from ``seed``.

    The low bits of a hash hold its band number, so hashes of different bands differ.

    Cosine hashes keep the signs of random projections. L2 hashes keep the cell of
    width ``width`` each projection falls into.
    """

    bands: int
    bits: int
    metric: str = "COSINE"
    width: float = 1.0
    seed: int = 17

    def __post_init__(self) -> None:
        positive_int(self.bands, "bands")
        positive_int(self.bits, "bits")
        if self.metric == "IP":
            raise QueryError("Hash bands need the COSINE or L2 metric")
        if self.bits > 64 - _BAND_BITS or self.bands > 2**_BAND_BITS:
            raise QueryError(f"bits must be at most {64 - _BAND_BITS} and bands at most {2**_BAND_BITS}")

    @classmethod
    def for_cosine(cls, threshold: float, recall: float = 0.98, max_bands: int = 64, seed: int = 17) -> Bands:
        """The most selective bands that still find a pair at ``threshold`` with the wanted chance.

        Two vectors at angle a agree on one bit with chance ``1 - a/pi``.
        """
        agree = 1.0 - math.acos(max(-1.0, 1.0 - threshold)) / math.pi
        for bits in range(24, 0, -1):
            miss = 1.0 - agree**bits
            bands = 1 if miss <= 0 else math.ceil(math.log(1.0 - recall) / math.log(miss))
            if bands <= max_bands:
                return cls(max(bands, 1), bits, "COSINE", seed=seed)
        return cls(max_bands, 1, "COSINE", seed=seed)

    def hashes(self, x: np.ndarray) -> np.ndarray:
        """One int64 per row and band."""
        draw = np.random.default_rng(self.seed)
        planes = draw.standard_normal((x.shape[1], self.bands * self.bits))
        shift = None
        if self.metric == "COSINE":
            base = np.int64(1) << np.arange(self.bits, dtype=np.int64)
        else:
            shift = draw.uniform(0, self.width, self.bands * self.bits)
            base = draw.integers(1, 2**31, self.bits, dtype=np.int64)
        out = np.empty((len(x), self.bands), dtype=np.int64)
        step = max(1, _PROJECTIONS // planes.shape[1])
        for at in range(0, len(x), step):
            values = x[at : at + step] @ planes
            digits = (values >= 0 if shift is None else np.floor((values + shift) / self.width)).astype(np.int64)
            cells = digits.reshape(len(values), self.bands, self.bits)
            with np.errstate(over="ignore"):
                out[at : at + step] = (cells @ base << _BAND_BITS) | np.arange(self.bands)
        return out

    def column(self, vector: Column, dims: int) -> Column:
        """``array<bigint>`` of band hashes; null for unusable vectors."""
        bands = self

        @F.arrow_udf(T.ArrayType(T.LongType()))
        def signature(v: pa.Array) -> pa.Array:
            x, rows = vector_matrix(v, dims)
            usable = np.zeros(len(v), dtype=bool)
            usable[rows] = True
            counts = np.where(usable, bands.bands, 0)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            return pa.ListArray.from_arrays(
                pa.array(offsets, mask=np.concatenate([~usable, [False]])), pa.array(bands.hashes(x).ravel())
            )

        return signature(vector)
