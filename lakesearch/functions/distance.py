"""Vector distances and their normalisation to similarity scores.

Distances are rounded to nine decimals. Equal vectors therefore get equal
distances whatever the summation order, ties fall back to the document key,
and a range threshold of zero finds identical vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from ..errors import QueryError
from ..schema import normalize_metric

DECIMALS = 9
# A raw distance may exceed its rounded value by this much.
MARGIN = 10.0**-DECIMALS
_PAIRS = 65536
# Distances looked at together: their single-precision products stay in a core's cache.
TILE, TILE_COLUMNS = 1 << 20, 4096
# Norms whose squares and products neither vanish nor overflow.
_SOUND = 1e-100, 1e100


def vector_matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a float64 matrix, and the positions of those rows.

    Null vectors, vectors of another length and vectors holding nulls or NaN are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    if len(rows) < len(column):
        column = column.take(pa.array(rows))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dims)
    usable = ~np.isnan(values).any(axis=1)
    return (values, rows) if usable.all() else (values[usable], rows[usable])


def distances(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Rounded distances between the rows of ``x`` and of ``q`` (rows x queries); NaN where undefined."""
    return rounded(raw_distances(x, q, metric))


def rounded(d: np.ndarray) -> np.ndarray:
    return np.round(d, DECIMALS) + 0.0


def raw_distances(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """:func:`distances` before rounding, for callers that round only what they keep."""
    if metric == "L2":
        scale = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", q, q)[None, :]
        square = scale - 2.0 * (x @ q.T)
        # The product form cancels for near-equal vectors, so those pairs are subtracted directly.
        near_x, near_q = np.nonzero(square < 1e-6 * scale)
        for at in range(0, len(near_x), _PAIRS):
            i, j = near_x[at : at + _PAIRS], near_q[at : at + _PAIRS]
            diff = x[i] - q[j]
            square[i, j] = np.einsum("ij,ij->i", diff, diff)
        out = np.sqrt(np.maximum(square, 0.0))
    else:
        out = x @ q.T
        if metric == "COSINE":
            norms = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None] * np.sqrt(np.einsum("ij,ij->i", q, q))[None, :]
            with np.errstate(divide="ignore", invalid="ignore"):
                np.divide(out, norms, out=out)
            out[norms == 0] = np.nan
        np.subtract(1.0, out, out=out)
    return out


class Vectors:
    """The rows of a matrix, for :func:`near_pairs`.

    For the cosine it also holds them at length one in single precision. The product of two
    such rows is off by less than ``(dims + 16) / 2**23``, so it tells which pairs can be near.
    """

    def __init__(self, x: np.ndarray, metric: str):
        self.x, self.metric = x, metric
        self.units: np.ndarray | None = None
        if metric == "COSINE":
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                self.norms = np.sqrt(np.einsum("ij,ij->i", x, x))
                # Rows without a direction become NaN, which is near nothing.
                if ((self.norms == 0) | (self.norms > _SOUND[0]) & (self.norms < _SOUND[1])).all():
                    self.units = (x / self.norms[:, None]).astype(np.float32)

    def __len__(self) -> int:
        return len(self.x)


def near_pairs(
    a: Vectors, rows: np.ndarray, b: Vectors, columns: np.ndarray, limit: Callable[[np.ndarray], float | np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``row, column, distance`` of the pairs whose distance before rounding is at most ``limit`` and ``MARGIN``.

    ``limit`` gives one number, or one for each of some columns; it is asked anew for every tile.
    """
    if not len(rows):
        return
    quick = a.units is not None and b.units is not None
    # Taken once: fresh pages for every tile would cost more than its products.
    room = min(TILE, len(rows) * min(len(columns), TILE_COLUMNS)) if quick else 0
    products, near = np.empty(room, np.float32), np.zeros(-(-room // 8) * 8, bool)
    for first in range(0, len(columns), TILE_COLUMNS):
        some = columns[first : first + TILE_COLUMNS]
        units = b.units[some].T if quick else None
        step = max(1, TILE // len(some))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            least = limit(some) + MARGIN
            if quick:
                slack = (a.x.shape[1] + 16) * 2.0**-23
                cells = len(part) * len(some)
                tile = np.matmul(a.units[part], units, out=products[:cells].reshape(len(part), len(some)))
                np.greater_equal(tile, np.float32(1.0 - slack) - np.asarray(least, np.float32), out=near[:cells].reshape(tile.shape))
                hits = _set(near, cells)
                if not len(hits):
                    continue
                if len(hits) <= cells // 64:
                    i, j = np.divmod(hits, len(some))
                    bound = least if np.ndim(least) == 0 else least[j]
                    i, j = part[i], some[j]
                    d = _of_pairs(a, i, b, j)
                    kept = d <= bound
                    yield i[kept], j[kept], d[kept]
                    continue
            d = raw_distances(a.x[part], b.x[some], a.metric)
            i, j = np.nonzero(d <= least)
            if len(i):
                yield part[i], some[j], d[i, j]


def _set(flags: np.ndarray, size: int) -> np.ndarray:
    """Where the first ``size`` of ``flags`` are set, of which few are: looked at by eight."""
    whole = -(-size // 8) * 8
    flags[size:whole] = False
    words = np.flatnonzero(flags[:whole].view(np.uint64))
    word, place = np.nonzero(flags[:whole].reshape(-1, 8)[words])
    return words[word] * 8 + place


def _of_pairs(a: Vectors, i: np.ndarray, b: Vectors, j: np.ndarray) -> np.ndarray:
    """Cosine distances of single pairs, some at a time."""
    out = np.empty(len(i))
    step = max(1, TILE // a.x.shape[1])
    for at in range(0, len(i), step):
        s, t = i[at : at + step], j[at : at + step]
        out[at : at + step] = 1.0 - np.einsum("ij,ij->i", a.x[s], b.x[t]) / (a.norms[s] * b.norms[t])
    return out


def distance_column(vector: Column, query: Sequence[float], metric: str) -> Column:
    """Distance of a vector column to one query vector, null for unusable vectors."""
    metric = normalize_metric(metric)
    q = np.asarray(query, dtype=np.float64).reshape(1, -1)
    if q.size == 0:
        raise QueryError("Vector cannot be empty")
    if np.isnan(q).any():
        raise QueryError("Vector contains NaN")

    @F.arrow_udf(T.DoubleType())
    def distance(v: pa.Array) -> pa.Array:
        x, rows = vector_matrix(v, q.shape[1])
        out = np.full(len(v), np.nan)
        out[rows] = distances(x, q, metric)[:, 0]
        return pa.array(out, mask=np.isnan(out))

    return distance(vector)


def normalized(distance: Column, metric: str) -> Column:
    """Similarity in [0, 1] of a cosine or L2 distance; inner products are left unchanged."""
    metric = normalize_metric(metric)
    if metric == "COSINE":
        return F.greatest((F.lit(2.0) - distance) / 2, F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + distance) if metric == "L2" else distance


def denormalized_cosine(similarity: Column) -> Column:
    """Cosine distance of a normalised similarity."""
    return F.greatest(F.lit(2.0) - similarity * 2, F.lit(0.0))
