"""Exact vector search: nearest neighbours and distance ranges.

One query vector is a literal of the plan. A table of queries that fits a measured
bound is broadcast and meets the documents where they lie. Any larger table meets
them on a grid: documents are dealt to rows and queries to columns by hash, each cell
of the grid is one stretch of a sorted task, in which the queries come first and the
documents stream past, and both tables are read once. Either way a kernel keeps the
best rows per query, so the shuffle after it carries at most tasks x queries x k rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..checks import natural_number, one_of, positive_int
from ..errors import QueryError
from ..functions.distance import MARGIN, TILE_COLUMNS, Vectors, distance_column, near_pairs, normalized, raw_distances, rounded, vector_matrix
from ..functions.predicates import FilterInput, filtered
from ..runtime import computed_once, with_documents
from ..schema import DocumentSchema, normalize_metric
from .search import paged, project_fields, sorted_rows

POLICIES = ("ADHOC_BF", "BATCHES")
JOINS = ("auto", "broadcast", "grid")
DEFAULT_ALIAS = "vector_distance"

# Bytes of query vectors that are broadcast or held by one cell of a grid, and distances computed at a time.
QUERY_BLOCK_BYTES = 16 * 1024 * 1024
CELLS = 1_000_000
# Cells of a grid at least, for each core.
CELLS_PER_CORE = 2


def knn(
    df: DataFrame,
    vector: Sequence[float] | None = None,
    field: str = "",
    k: int = 10,
    where: FilterInput = None,
    fields: Iterable[str] | None = None,
    metric: str | None = None,
    offset: int | None = None,
    limit: int | None = None,
    alias: str = DEFAULT_ALIAS,
    normalize: bool = False,
    sort_by: str | None = None,
    sort_order: str | None = None,
    queries: DataFrame | None = None,
    query_id: str = "query_id",
    query_vector: str = "vector",
    schema: DocumentSchema | None = None,
    join: str = "auto",
) -> DataFrame:
    """The ``k`` nearest documents, nearest first; the filter applies before ``k`` is taken.

    Pass ``vector`` for one query or ``queries`` (id and vector columns) for many; ``join`` says how these
    reach the documents: ``broadcast``, over a ``grid``, or by their measured size.
    ``offset``/``limit`` page inside the ``k`` rows. With ``normalize`` a ``score``
    column is added beside the raw distance.
    """
    positive_int(k, "k")
    metric = search_metric(schema, field, metric)
    source = filtered(df, where, schema)
    key = schema.key if schema is not None else "_key"
    if queries is not None:
        hits = batch_search(source, queries, field, metric, key, query_id, query_vector, k=k, alias=alias, join=join)
        most = queries.count() * k if fields else None
        return _finish_batch(hits.drop("rank"), df, schema, fields, alias, normalize, metric, query_id, most)
    found = with_distance(source, vector, field, metric, alias, schema)
    found = project_fields(found, schema, fields, [alias, *([sort_by] if sort_by else [])])
    found = found.orderBy(alias, key).limit(k)
    if sort_by is not None:
        found = sorted_rows(found, sort_by, sort_order, key)
    found = paged(found, offset, limit)
    return with_score(found, alias, metric) if normalize else found


def vector_range(
    df: DataFrame,
    vector: Sequence[float] | None = None,
    field: str = "",
    threshold: float = 0.2,
    where: FilterInput = None,
    fields: Iterable[str] | None = None,
    metric: str | None = None,
    offset: int | None = None,
    limit: int | None = None,
    alias: str = DEFAULT_ALIAS,
    normalize: bool = False,
    sort_by: str | None = None,
    sort_order: str | None = None,
    queries: DataFrame | None = None,
    query_id: str = "query_id",
    query_vector: str = "vector",
    schema: DocumentSchema | None = None,
    join: str = "auto",
) -> DataFrame:
    """Every document within ``threshold`` of a query vector.

    One query's rows come ordered by distance and key. For a table of queries the
    rows are unordered pairs, because a global sort would only cost a shuffle.
    """
    natural_number(threshold, "threshold")
    metric = search_metric(schema, field, metric)
    source = filtered(df, where, schema)
    key = schema.key if schema is not None else "_key"
    if queries is not None:
        hits = batch_search(source, queries, field, metric, key, query_id, query_vector, radius=threshold, alias=alias, join=join)
        return _finish_batch(hits, df, schema, fields, alias, normalize, metric, query_id)
    found = with_distance(source, vector, field, metric, alias, schema).where(F.col(alias) <= threshold)
    found = project_fields(found, schema, fields, [alias, *([sort_by] if sort_by else [])])
    found = sorted_rows(found, sort_by or alias, sort_order if sort_by else None, key)
    found = paged(found, offset, limit)
    return with_score(found, alias, metric) if normalize else found


# -- pieces shared with the approximate and hybrid searches ---------------------


def search_metric(schema: DocumentSchema | None, field: str, metric: str | None) -> str:
    """The metric declared for the field, else the one given with the query, else cosine."""
    if not field:
        raise QueryError("A vector search needs the name of a vector field")
    spec = schema.field(field) if schema is not None else None
    if spec is not None and spec.role == "vector":
        return spec.metric
    return normalize_metric(metric)


def check_policy(policy: str | None, batch_size: int | None) -> None:
    if policy is not None:
        one_of(policy, POLICIES, "policy")
    if batch_size is not None:
        if policy is None:
            raise QueryError("batch_size needs a policy")
        positive_int(batch_size, "batch_size")


def vector_name(schema: DocumentSchema | None, field: str) -> str:
    spec = schema.field(field) if schema is not None else None
    return spec.alias if spec is not None else field


def with_distance(
    df: DataFrame, vector: Sequence[float] | None, field: str, metric: str, alias: str, schema: DocumentSchema | None
) -> DataFrame:
    """``df`` with its distance to one vector; rows without a usable vector are left out."""
    if vector is None or len(vector) == 0:
        raise QueryError("Vector cannot be empty")
    column = F.col(f"`{vector_name(schema, field)}`")
    found = computed_once(df.withColumn("_vector", column).drop(alias), **{alias: distance_column(F.col("_vector"), vector, metric)})
    return found.drop("_vector").where(F.col(alias).isNotNull())


def with_score(df: DataFrame, alias: str, metric: str) -> DataFrame:
    return df.withColumn("score", normalized(F.col(alias), metric))


def batch_search(
    docs: DataFrame,
    queries: DataFrame,
    field: str,
    metric: str,
    key: str,
    query_id: str,
    query_vector: str,
    k: int | None = None,
    radius: float | None = None,
    alias: str = DEFAULT_ALIAS,
    cell: str | None = None,
    probes: str | None = None,
    join: str = "auto",
    block_bytes: int | None = None,
) -> DataFrame:
    """``(query_id, key, distance[, rank])`` for a table of queries.

    With ``cell``/``probes`` a query only meets the documents whose cell is in its
    ``probes`` array; this is how the inverted-file search reuses the kernel.
    """
    one_of(join, JOINS, "join")
    limit = block_bytes or QUERY_BLOCK_BYTES
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{field}`").alias("vector"), *([F.col(f"`{cell}`").alias("cell")] if cell else []))
    asked = queries.select(F.col(f"`{query_id}`").alias("id"), F.col(f"`{query_vector}`").alias("vector"), *([F.col(f"`{probes}`").alias("probes")] if probes else []))
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(key, docs.schema[key].dataType),
            T.StructField(alias, T.DoubleType()),
        ]
    )
    size = vector_bytes(asked)
    if join == "broadcast" or (join == "auto" and size <= limit):
        hits = source.mapInArrow(_broadcast_kernel(docs.sparkSession, asked.toArrow(), schema, metric, k, radius), schema)
    else:
        hits = _grid(source, asked, -(-size // limit) or 1).mapInArrow(_grid_kernel(schema, metric, k, radius), schema)
    if k is None:
        return hits
    order = Window.partitionBy(query_id).orderBy(alias, key)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vector_bytes(df: DataFrame) -> int:
    """Bytes of the ``vector`` column, by one aggregate."""
    return df.agg(F.sum(F.greatest(F.size("vector"), F.lit(1)).cast("long") * 8 + 64)).first()[0] or 0


def _grid(docs: DataFrame, queries: DataFrame, columns: int) -> DataFrame:
    """Both tables in one: ``cell number, is document, ...``, each cell's queries before its documents.

    A query goes to every row of its column, a document to every column of its row. A row more means
    another copy of the queries and of their best rows, so there are no more than keep all cores busy.
    Documents only stream past, so a cell of any height fits its task.
    """
    spark = docs.sparkSession
    cells = min(int(spark.conf.get("spark.sql.shuffle.partitions")), CELLS_PER_CORE * spark.sparkContext.defaultParallelism)
    rows = max(1, -(-cells // columns))
    dealt = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("_column", dealt(queries, columns)).withColumn("_row", each(rows))
    held = docs.withColumn("_row", dealt(docs, rows)).withColumn("_column", each(columns))
    number = (F.col("_row") * columns + F.col("_column")).alias("grid")
    asked = asked.select(number, F.lit(False).alias("document"), *queries.columns)
    held = held.select(number, F.lit(True).alias("document"), *docs.columns)
    both = asked.unionByName(held, allowMissingColumns=True)
    # Every cell is a partition.
    return both.repartitionById(rows * columns, "grid").sortWithinPartitions("grid", "document")


def _broadcast_kernel(spark, block: pa.Table, schema: T.StructType, metric: str, k: int | None, radius: float | None):
    shared = spark.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting = _Meeting(shared.value, schema, metric, k, radius)
        for batch in batches:
            yield from meeting.documents(batch)
        yield from meeting.best()

    return search


def _grid_kernel(schema: T.StructType, metric: str, k: int | None, radius: float | None):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, meeting = None, [], None
        for batch in batches:
            numbers = batch.column("grid").to_numpy()
            kinds = batch.column("document").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(numbers) != 0) | (kinds[1:] != kinds[:-1])) + 1
            for start, end in zip([0, *turns], [*turns, len(numbers)], strict=True):
                if start == end:
                    continue
                if numbers[start] != cell:
                    if meeting is not None:
                        yield from meeting.best()
                    cell, asked, meeting = numbers[start], [], None
                rows = batch.slice(start, end - start)
                if not kinds[start]:
                    asked.append(rows.select([c for c in rows.schema.names if c in ("id", "vector", "probes")]))
                elif asked:
                    meeting = meeting or _Meeting(pa.Table.from_batches(asked), schema, metric, k, radius)
                    yield from meeting.documents(rows.select([c for c in rows.schema.names if c in ("key", "vector", "cell")]))
        if meeting is not None:
            yield from meeting.best()

    return search


class _Meeting:
    """A block of queries that documents stream past."""

    def __init__(self, table: pa.Table, schema: T.StructType, metric: str, k: int | None, radius: float | None):
        self._table, self._names, self._metric, self._radius = table, schema.fieldNames(), metric, radius
        self._groups = list(_by_dims(table, metric))
        self._best = TopK(k, table.num_rows) if k is not None else None

    def documents(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The documents ``key, vector[, cell]`` within the radius; with ``k`` they are only remembered."""
        keys, vectors = batch.column("key"), batch.column("vector")
        for dims, asked, rows in self._groups:
            x, docs = vector_matrix(vectors, dims)
            if not len(docs):
                continue
            held = Vectors(x, self._metric)
            for part, chosen in _cells(batch, docs, self._table, rows):
                if self._best is not None:
                    self._remember(held, part, asked, chosen, rows, keys, docs)
                    continue
                for i, j, near in near_pairs(held, part, asked, chosen, lambda _: self._radius):
                    near = rounded(near)
                    hit = near <= self._radius
                    yield self._rows(rows[j[hit]], keys.take(pa.array(docs[i[hit]])), near[hit])

    def _remember(self, held: Vectors, part: np.ndarray, asked: Vectors, chosen: np.ndarray, rows: np.ndarray, keys: pa.Array, docs: np.ndarray) -> None:
        """Keep what can be among the ``k`` best, for some of the queries at a time."""
        edge = self._best.edge
        for at in range(0, len(chosen), TILE_COLUMNS):
            some, left = chosen[at : at + TILE_COLUMNS], part
            step = max(1, CELLS // len(some))
            # Until a query has met ``k`` documents, every one may be among them.
            while len(left) and np.isinf(edge[rows[some]]).any():
                first, left = left[:step], left[step:]
                d = raw_distances(held.x[first], asked.x[some], self._metric)
                self._best.add(d, rows[some], keys.take(pa.array(docs[first])))
            for i, j, near in near_pairs(held, left, asked, some, lambda columns: edge[rows[columns]]):
                self._best.take(rows[j], near, keys.take(pa.array(docs[i])))

    def best(self) -> Iterator[pa.RecordBatch]:
        """The ``k`` best documents of each query so far."""
        if self._best is not None:
            for query_rows, found, near in self._best.results():
                yield self._rows(query_rows, found, near)

    def _rows(self, query_rows: np.ndarray, keys: pa.Array, values: np.ndarray) -> pa.RecordBatch:
        ids = self._table.column("id").take(pa.array(query_rows, pa.int64())).combine_chunks()
        return pa.RecordBatch.from_arrays([ids, keys, pa.array(values)], names=self._names)


class TopK:
    """The ``k`` smallest (distance, key) pairs per query, over everything added so far."""

    def __init__(self, k: int, queries: int):
        self.k = k
        self.limit = max(2 * k * queries, 20_000)
        # Nothing beyond its query's edge can enter the result.
        self.edge = np.full(queries, np.inf)
        self.parts: list[pa.Table] = []
        self.size = 0

    def add(self, d: np.ndarray, queries: np.ndarray, keys: pa.Array) -> None:
        bound = self.edge[queries]
        if len(d) > self.k and np.isinf(bound).any():
            kth = np.partition(d, self.k - 1, axis=0)[self.k - 1]
            self.edge[queries] = bound = np.fmin(bound, rounded(kth))
        doc, query = np.nonzero(d <= bound + MARGIN)
        if len(doc):
            self.take(queries[query], d[doc, query], keys.take(pa.array(doc)))

    def take(self, queries: np.ndarray, d: np.ndarray, keys: pa.Array) -> None:
        """Add single pairs, without a look at the edges."""
        self.parts.append(pa.table({"query": queries, "d": rounded(d), "key": keys}))
        self.size += len(d)
        if self.size > self.limit:
            self._compact()

    def _compact(self) -> None:
        table = pa.concat_tables(self.parts)
        table = table.sort_by([("query", "ascending"), ("d", "ascending"), ("key", "ascending")])
        query = table.column("query").to_numpy()
        start = np.searchsorted(query, query, side="left")
        place = np.arange(len(query)) - start
        full = place == self.k - 1
        self.edge[query[full]] = table.column("d").to_numpy()[full]
        table = table.filter(pa.array(place < self.k))
        self.parts, self.size = [table], table.num_rows

    def results(self) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
        if not self.parts:
            return
        self._compact()
        for batch in self.parts[0].combine_chunks().to_batches(max_chunksize=100_000):
            yield batch.column(0).to_numpy(), batch.column(2), batch.column(1).to_numpy()


def _by_dims(table: pa.Table, metric: str):
    """Usable query vectors grouped by length: (dims, vectors, row numbers in the block)."""
    column = table.column("vector").combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths[lengths > 0]):
        q, rows = vector_matrix(column, int(dims))
        if metric == "COSINE":
            directed = (q != 0).any(axis=1)
            q, rows = q[directed], rows[directed]
        if len(rows):
            yield int(dims), Vectors(q, metric), rows


def _cells(batch: pa.RecordBatch, docs: np.ndarray, table: pa.Table, rows: np.ndarray):
    """Which documents meet which queries: all with all, or by probed cell."""
    if "cell" not in batch.schema.names or "probes" not in table.schema.names:
        yield np.arange(len(docs)), np.arange(len(rows))
        return
    cells = batch.column("cell").to_numpy(zero_copy_only=False)[docs]
    probes = table.column("probes").combine_chunks().take(pa.array(rows))
    owner = np.repeat(np.arange(len(rows)), probes.value_lengths().to_numpy(zero_copy_only=False))
    probed = probes.flatten().to_numpy(zero_copy_only=False)
    for cell in np.unique(cells):
        chosen = owner[probed == cell]
        if len(chosen):
            yield np.flatnonzero(cells == cell), chosen


def _finish_batch(
    hits: DataFrame,
    df: DataFrame,
    schema: DocumentSchema | None,
    fields: Iterable[str] | None,
    alias: str,
    normalize: bool,
    metric: str,
    query_id: str,
    most: int | None = None,
) -> DataFrame:
    """Attach the asked fields to batch hits by key, after the hits are final."""
    key = schema.key if schema is not None else "_key"
    if fields:
        wide = project_fields(df, schema, fields)
        hits = with_documents(wide, hits, key, most).select(query_id, key, *[c for c in wide.columns if c != key], alias)
    return with_score(hits, alias, metric) if normalize else hits
