"""Similarity join: pairs of documents whose vectors lie within a distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..checks import natural_number, one_of
from ..functions.distance import DECIMALS, Vectors, distances, near_pairs, rounded, vector_matrix
from ..functions.hashing import Bands
from ..runtime import broadcast_if_small, written
from ..schema import DocumentSchema
from .vectors import CELLS, CELLS_PER_CORE, batch_search, search_metric, vector_bytes, vector_name

METHODS = ("lsh", "exact")

# Rows of one hash bucket that meet in one task; larger buckets are cut into chunks.
CHUNK = 2048
# Bytes of vectors that one cell of a self-join holds while others stream past.
HELD_BYTES = 96 * 1024 * 1024
# Rows of a block that meet the rows after them at a time.
STEP = 4096


def usable(vector: Column, metric: str) -> Column:
    """Whether distances to a vector are defined: no null or NaN inside and, for the cosine, not all zero."""
    sound = vector.isNotNull() & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v))
    return F.coalesce(sound & F.exists(vector, lambda v: v != 0) if metric == "COSINE" else sound, F.lit(False))


def distinct_vectors(df: DataFrame, key: str, field: str, metric: str) -> tuple[DataFrame, DataFrame]:
    """One row per distinct usable vector with its smallest key, and the ``(representative, member, _v)`` copies.

    Copies collapse on the map side, so a vector shared by a third of all rows costs
    one row per task.
    """
    vector = F.col(f"`{field}`")
    rows = df.where(usable(vector, metric)).select(F.col(f"`{key}`").alias("_k"), vector.alias("_v"))
    # Written once: the join reads the distinct vectors several times.
    heads = written(rows.groupBy("_v").agg(F.min("_k").alias("_k"), F.count(F.lit(1)).alias("_n")), "vectors")
    many = heads.where("_n > 1").select(F.xxhash64("_v").alias("_h"), "_v", F.col("_k").alias("representative"))
    tagged = rows.withColumn("_h", F.xxhash64("_v"))
    shared = broadcast_if_small(many)
    members = tagged.join(shared, (tagged["_h"] == shared["_h"]) & (tagged["_v"] == shared["_v"]))
    members = members.select("representative", F.col("_k").alias("member"), tagged["_v"]).where("member != representative")
    return heads.select("_k", "_v"), members


def similarity_join(
    left: DataFrame,
    right: DataFrame | None = None,
    field: str = "",
    threshold: float = 0.2,
    method: str = "lsh",
    metric: str | None = None,
    bands: Bands | None = None,
    chunk: int = CHUNK,
    schema: DocumentSchema | None = None,
    every: bool = False,
) -> DataFrame:
    """``(left_key, right_key, distance)`` of pairs within ``threshold``.

    Without ``right`` the table is joined with itself in compact form: pairs of
    representatives, each once, and every copy paired with its representative (see
    ``similarity_classes`` for the two apart). All other pairs follow through them, and
    a hot vector gives a linear number of rows. With ``every`` the self-join returns all
    pairs of rows whose left key is the smaller one, copies included, and repeated keys
    as often as they occur. With ``right`` every left row meets every right row, copies
    included. Vectors without a defined distance never occur.

    ``lsh`` joins on equal band hashes and rechecks the true distance; it may miss
    pairs at the chance its bands allow. ``exact`` compares all vectors, a block with
    another at a time. Vectors of different lengths never pair.
    """
    every = every or right is not None
    pairs, members = _joined(left, right, field, threshold, method, metric, bands, chunk, schema, every)
    if every:
        return pairs
    return pairs.unionByName(members.select(F.col("representative").alias("left_key"), F.col("member").alias("right_key"), "distance"))


def similarity_classes(
    df: DataFrame,
    field: str = "",
    threshold: float = 0.2,
    method: str = "lsh",
    metric: str | None = None,
    bands: Bands | None = None,
    chunk: int = CHUNK,
    schema: DocumentSchema | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The self-join in two tables: pairs of representatives, and ``(representative, member, distance)``.

    A representative has the smallest key of its equal vectors. Members are listed if
    their distance, which under the inner product need not be 0, is within ``threshold``.
    """
    return _joined(df, None, field, threshold, method, metric, bands, chunk, schema)


def _joined(left, right, field, threshold, method, metric, bands, chunk, schema, every=False) -> tuple[DataFrame, DataFrame | None]:
    natural_number(threshold, "threshold")
    one_of(method, METHODS, "method")
    metric = search_metric(schema, field, metric)
    key = schema.key if schema is not None else "_key"
    column = vector_name(schema, field)
    own = right is None
    if every:
        members = None
        probes, heads = (
            t.where(usable(F.col(f"`{column}`"), metric)).select(F.col(f"`{key}`").alias("_k"), F.col(f"`{column}`").alias("_v"))
            for t in (left, left if own else right)
        )
    else:
        heads, members = distinct_vectors(left, key, column, metric)
        probes = heads
    spec = schema.field(field) if schema is not None else None
    # The lengths that vectors have; a declared field has one.
    sizes = [spec.dims] if spec is not None else sorted(r[0] for r in heads.select(F.size("_v")).distinct().collect())
    pairs = None
    for dims in sizes or [1]:
        right_rows, left_rows = (rows.where(F.size("_v") == dims) for rows in (heads, probes))
        spread = None
        if method == "lsh":
            spread = bands or (Bands.for_cosine(threshold) if metric == "COSINE" else Bands(16, 4, metric, 4 * threshold or 1.0))
        if own and (spread is None or _meet_anyway(spread)):
            found = _all_with_all(right_rows, dims, threshold, metric, spread)
        elif spread is None:
            found = _exact(left_rows, right_rows, threshold, metric)
        else:
            found = _banded(left_rows, right_rows, dims, threshold, metric, spread, chunk, own)
        pairs = found if pairs is None else pairs.unionByName(found)
    if not every:
        itself = F.lit(0.0)
        if metric == "IP":
            itself = F.round(1.0 - F.aggregate(F.col("_v").cast("array<double>"), F.lit(0.0), lambda a, v: a + v * v), DECIMALS)
        members = members.where(F.size("_v").isin(*sizes or [1])).select("representative", "member", itself.alias("distance"))
        members = members.where(F.col("distance") <= threshold)
    return pairs, members


def _exact(probes: DataFrame, heads: DataFrame, threshold: float, metric: str) -> DataFrame:
    hits = batch_search(
        heads, probes.withColumnRenamed("_k", "left_key"), "_v", metric, "_k", "left_key", "_v",
        radius=threshold, alias="distance",
    )
    return hits.select("left_key", F.col("_k").alias("right_key"), "distance")


def _meet_anyway(bands: Bands) -> bool:
    """Whether the buckets of all bands hold half of all pairs or more, however the vectors lie.

    A cosine hash has ``2**bits`` values, so a band's buckets hold no less than that share of the pairs. Then
    it is cheaper to let every pair meet once than once a shared bucket, with a copy of the vector a band.
    """
    return bands.metric == "COSINE" and 2 * bands.bands >= 2**bands.bits


def _all_with_all(rows: DataFrame, dims: int, threshold: float, metric: str, bands: Bands | None) -> DataFrame:
    """Pairs of rows within ``threshold``, of different keys; with ``bands`` those that agree on one of them.

    Rows are dealt to blocks by hash, and every two blocks meet in a cell, which is a partition: one is held
    there, the other streams past. A block is copied once for each block, and no pair meets twice.
    """
    spark = rows.sparkSession
    key = rows.schema["_k"].dataType
    rows = rows.where(F.col("_k").isNotNull())
    size = vector_bytes(rows.select(F.col("_v").alias("vector")))
    cells = min(int(spark.conf.get("spark.sql.shuffle.partitions")), CELLS_PER_CORE * spark.sparkContext.defaultParallelism)
    blocks = max(1, -(-size // HELD_BYTES))
    while blocks * blocks < cells:  # a block's meeting with itself is half the work
        blocks += 1
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("_k", "_v"), F.lit(blocks)).cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    low, high = F.least("_b", "_o"), F.greatest("_b", "_o")
    number = (low * blocks - F.floor(low * (low - 1) / 2).cast("int") + high - low).alias("_cell")
    rows = rows.select(number, (F.col("_b") != low).alias("_late"), (low == high).alias("_alone"), "_k", "_v")
    rows = rows.repartitionById(blocks * (blocks + 1) // 2, "_cell").sortWithinPartitions("_cell", "_late")
    schema = T.StructType(
        [T.StructField("_ka", key), T.StructField("_kb", key), T.StructField("distance", T.DoubleType())]
    )
    pairs = rows.mapInArrow(_cell_kernel(dims, threshold, metric, bands), schema).where("_ka != _kb")
    return pairs.select(F.least("_ka", "_kb").alias("left_key"), F.greatest("_ka", "_kb").alias("right_key"), "distance")


def _cell_kernel(dims: int, threshold: float, metric: str, bands: Bands | None):
    """Pairs of the two blocks of each cell; where both are one block, pairs within it."""

    class Block:
        def __init__(self, parts: list[pa.RecordBatch]):
            table = pa.Table.from_batches(parts)
            x, rows = vector_matrix(table.column("_v"), dims)
            self.keys = table.column("_k").combine_chunks().take(pa.array(rows))
            self.vectors = Vectors(x, metric)
            self.hashes = bands.hashes(x) if bands is not None else None

    def meet(cell: Iterator[tuple[bool, bool, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        held = None
        alone = False
        for late, alone, rows in cell:
            if not late:
                parts.append(rows)
                continue
            held = held or (Block(parts) if parts else None)
            if held is not None:
                other = Block([rows])
                yield from near(other, np.arange(len(other.vectors)), held, np.arange(len(held.vectors)))
        if alone and parts:
            held = Block(parts)
            n = len(held.vectors)
            for at in range(0, n, STEP):
                yield from near(held, np.arange(at, min(at + STEP, n)), held, np.arange(at, n), upper=True)

    def near(a, rows, b, columns, upper: bool = False) -> Iterator[pa.RecordBatch]:
        for i, j, d in near_pairs(a.vectors, rows, b.vectors, columns, lambda _: threshold):
            d = rounded(d)
            kept = d <= threshold
            if upper:
                kept &= i < j
            i, j, d = i[kept], j[kept], d[kept]
            if bands is not None:
                step = max(1, CELLS // bands.bands)
                agree = [(a.hashes[i[at : at + step]] == b.hashes[j[at : at + step]]).any(axis=1) for at in range(0, len(i), step)]
                agree = np.concatenate(agree) if agree else np.zeros(0, bool)
                i, j, d = i[agree], j[agree], d[agree]
            if len(i):
                yield pa.RecordBatch.from_arrays([a.keys.take(pa.array(i)), b.keys.take(pa.array(j)), pa.array(d)], names=["_ka", "_kb", "distance"])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, bool, pa.RecordBatch]]:
        for batch in batches:
            cells = batch.column("_cell").to_numpy()
            late = batch.column("_late").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(cells) != 0) | (late[1:] != late[:-1])) + 1
            for start, end in zip([0, *turns], [*turns, len(cells)], strict=True):
                if start < end:
                    yield int(cells[start]), bool(late[start]), batch.column("_alone")[int(start)].as_py(), batch.slice(start, end - start).select(["_k", "_v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cell in groupby(stretches(batches), key=lambda s: s[0]):
            yield from meet(s[1:] for s in cell)

    return search


def _banded(
    probes: DataFrame, heads: DataFrame, dims: int, threshold: float, metric: str, bands: Bands, chunk: int, own: bool
) -> DataFrame:
    right = _spread(heads, dims, bands)
    left = right if own else _spread(probes, dims, bands)
    if own:
        # Row of chunk c meets every chunk t of its bucket in the meeting (min(c, t), max(c, t)).
        rows = _chunked(right, right, chunk, "_m")
        other = F.explode(F.sequence(F.lit(0), F.col("_m") - 1))
        rows = rows.withColumn("_t", other).withColumn("_left", F.col("_c") <= F.col("_t"))
        rows = rows.withColumn("_i", F.least("_c", "_t")).withColumn("_j", F.greatest("_c", "_t"))
    else:
        a = _chunked(_chunked(left, left, chunk, "_m"), right, chunk, "_n", own_chunk=False)
        b = _chunked(_chunked(right, right, chunk, "_m"), left, chunk, "_n", own_chunk=False)
        other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
        a = a.withColumn("_j", other).withColumn("_i", F.col("_c")).withColumn("_left", F.lit(True))
        b = b.withColumn("_i", other).withColumn("_j", F.col("_c")).withColumn("_left", F.lit(False))
        columns = ["_hash", "_i", "_j", "_left", "_k", "_v", "_signature"]
        rows = a.select(*columns).unionByName(b.select(*columns))
    meeting = ["_hash", "_i", "_j"]
    rows = rows.select(*meeting, "_left", "_k", "_v", "_signature")
    # The work per byte is high, so the partitions are not merged by size.
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(count, *meeting).sortWithinPartitions(*meeting)
    key = heads.schema["_k"].dataType
    schema = T.StructType(
        [T.StructField("_ka", key), T.StructField("_kb", key), T.StructField("distance", T.DoubleType())]
    )
    pairs = rows.mapInArrow(_meeting_kernel(dims, threshold, metric, own), schema)
    if own:
        pairs = pairs.where("_ka != _kb")
    first: Column = F.least("_ka", "_kb") if own else F.col("_ka")
    second: Column = F.greatest("_ka", "_kb") if own else F.col("_kb")
    return pairs.select(first.alias("left_key"), second.alias("right_key"), "distance")


def _spread(rows: DataFrame, dims: int, bands: Bands) -> DataFrame:
    signed = rows.withColumn("_signature", bands.column(F.col("_v"), dims)).where(F.col("_signature").isNotNull())
    signed = written(signed, "signatures")
    return signed.select("_k", "_v", "_signature", F.explode("_signature").alias("_hash"))


def _chunked(rows: DataFrame, counted: DataFrame, chunk: int, count: str, own_chunk: bool = True) -> DataFrame:
    """Add to every row how many chunks its bucket has in ``counted``, and its own chunk number.

    Only buckets above the chunk size are listed: at most rows x bands / chunk of them.
    """
    sizes = counted.groupBy("_hash").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > chunk)
    hot = broadcast_if_small(sizes.select("_hash", F.ceil(F.col("_size") / chunk).cast("int").alias(count)))
    rows = rows.join(hot, "_hash", "left").withColumn(count, F.coalesce(count, F.lit(1)))
    if not own_chunk:
        return rows
    return rows.withColumn("_c", F.pmod(F.xxhash64("_k"), F.col(count)).cast("int"))


def _meeting_kernel(dims: int, threshold: float, metric: str, own: bool):
    """Compare the rows of each meeting; input is sorted by meeting, so one passes through at a time.

    Vectors cross to Python once per bucket row instead of once per candidate pair. A pair
    that agrees on several bands is kept in the first one only, so no dedupe shuffle follows.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            edges = group_edges(table)
            last = int(edges[-2])
            held = table.slice(last).combine_chunks()
            if last:
                yield from pairs_of(table.slice(0, last).combine_chunks(), edges[:-1])
        if held is not None:
            yield from pairs_of(held, np.array([0, held.num_rows]))

    def group_edges(table: pa.Table) -> np.ndarray:
        changed = np.zeros(table.num_rows, dtype=bool)
        changed[0] = True
        for name in ("_hash", "_i", "_j"):
            values = table.column(name).to_numpy()
            changed[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(changed), table.num_rows)

    def pairs_of(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        x, usable = vector_matrix(table.column("_v"), dims)
        if len(usable) < table.num_rows:
            raise ValueError("a hashed vector is unusable")
        keys = table.column("_k").combine_chunks()
        hashes = table.column("_hash").to_numpy()
        left = table.column("_left").to_numpy()
        same_chunk = table.column("_i").to_numpy() == table.column("_j").to_numpy()
        signature = table.column("_signature").combine_chunks().flatten().to_numpy().reshape(len(x), -1)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0
        for start, end in zip(edges[:-1], edges[1:]):
            if end - start < 2:
                continue
            rows = np.arange(start, end)
            triangle = own and same_chunk[start]
            a, b = (rows, rows) if triangle else (rows[left[start:end]], rows[~left[start:end]])
            step = max(1, CELLS // max(1, len(b)))
            for at in range(0, len(a), step):
                part = a[at : at + step]
                d = distances(x[part], x[b], metric)
                near_a, near_b = np.nonzero(d <= threshold)
                ia, ib, near = part[near_a], b[near_b], d[near_a, near_b]
                if triangle:
                    upper = ia < ib
                    ia, ib, near = ia[upper], ib[upper], near[upper]
                found.append((ia, ib, near))
                waiting += len(ia)
                if waiting > CELLS:
                    yield emit(found, keys, hashes, signature)
                    found, waiting = [], 0
        if found:
            yield emit(found, keys, hashes, signature)

    def emit(found, keys, hashes, signature) -> pa.RecordBatch:
        ia, ib, near = (np.concatenate(parts) for parts in zip(*found))
        kept = np.zeros(len(ia), dtype=bool)
        for at in range(0, len(ia), 100_000):
            part = slice(at, at + 100_000)
            first = (signature[ia[part]] == signature[ib[part]]).argmax(axis=1)
            kept[part] = signature[ia[part], first] == hashes[ia[part]]
        ia, ib, near = ia[kept], ib[kept], near[kept]
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(ia)), keys.take(pa.array(ib)), pa.array(near)], names=["_ka", "_kb", "distance"]
        )

    return compare
