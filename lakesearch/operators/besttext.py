"""The best documents of many text queries, without a row for each query and document.

Postings are dealt by document and stream through each task in blocks of whole documents.
For a block, the greatest part of each term bounds what any of its documents can reach; a
query whose bound stays below the ``k``-th best score that it has in this task skips the
block. Else its terms are split: those which together cannot lift a document over that
score are left until a document has shown, by the others, that it may. What a task emits is
at most ``k`` rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .vectors import TopK

# Bytes of query terms broadcast at a time; postings of a block.
TERM_BYTES = 32 * 1024 * 1024
BLOCK = 200_000
# Sums of the same parts in another order differ by less.
MARGIN = 2e-9


def unit(field: Column, term: Column) -> Column:
    """A term of a field as one string."""
    return F.concat(field, F.lit("\0"), term)


def best_documents(
    parts: DataFrame, terms: DataFrame, fields: list[str], query_id: str, key: str, k: int, alias: str, widest: bool = False, limit: int | None = None, block: int = BLOCK
) -> DataFrame:
    """``(query_id, key, score)``: at least the ``k`` best documents of every query that has matches.

    ``parts`` has ``key, field, term, _part`` with parts of 0 or more, ``terms`` ``query_id, term, weight``.
    A document's score is the sum of part times weight, or with ``widest`` the greatest such sum of a
    field, to nine decimals. Equal scores are in the order of keys. The terms are broadcast in as many blocks of
    ``limit`` bytes as they measure.
    """
    each = F.explode(F.array(*[F.lit(f) for f in fields])).alias("field")
    asked = terms.select(F.col(f"`{query_id}`").alias("id"), "term", "weight", each)
    asked = asked.select("id", "field", unit(F.col("field"), F.col("term")).alias("unit"), "weight")
    size = asked.agg(F.sum(F.octet_length("unit").cast("long") + 40)).first()[0] or 0
    count = -(-size // (limit or TERM_BYTES))
    schema = T.StructType(
        [
            T.StructField(query_id, terms.schema[query_id].dataType),
            T.StructField(key, parts.schema[key].dataType),
            T.StructField(alias, T.DoubleType()),
        ]
    )
    source = parts.select(F.col(f"`{key}`").alias("key"), unit(F.col("field"), F.col("term")).alias("unit"), F.col("_part").cast("double").alias("part"))
    source = source.repartition("key").sortWithinPartitions("key")
    hits = parts.sparkSession.createDataFrame([], schema)
    for b in range(count):
        some = asked if count == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(count)) == b)
        shared = parts.sparkSession.sparkContext.broadcast(some.toArrow())
        found = source.mapInArrow(_kernel(shared, schema, k, widest, block), schema)
        hits = found if b == 0 else hits.unionByName(found)
    return hits


def _kernel(shared, schema: T.StructType, k: int, widest: bool, block: int):
    names = schema.fieldNames()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Queries(shared.value, k, widest)
        waiting: list[pa.Table] = []
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in waiting) >= block:
                whole = pa.concat_tables(waiting).combine_chunks()
                ends = _document_ends(whole)
                cut = int(ends[-2]) if len(ends) > 1 else 0  # the last document may go on
                queries.meet(whole.slice(0, cut), ends[:-1])
                waiting = [whole.slice(cut)]
        if waiting:
            whole = pa.concat_tables(waiting).combine_chunks()
            queries.meet(whole, _document_ends(whole))
        for query_rows, keys, less in queries.best.results():
            ids = queries.ids.take(pa.array(query_rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(0.0 - less)], names=names)

    return search


def _document_ends(rows: pa.Table) -> np.ndarray:
    """Where each document's postings end; rows lie in the order of documents."""
    if not rows.num_rows:
        return np.zeros(0, np.int64)
    return pc.run_end_encode(rows.column("key").combine_chunks()).run_ends.to_numpy().astype(np.int64)


class _Queries:
    """The terms of a block of queries, and the best documents that each has met."""

    def __init__(self, table: pa.Table, k: int, widest: bool):
        coded = table.column("id").combine_chunks().dictionary_encode(null_encoding="encode")
        self.ids = coded.dictionary
        query = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(query, kind="stable")
        units = table.column("unit").combine_chunks().dictionary_encode()
        fields = table.column("field").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        self._units = units.dictionary
        self._query, self._unit = query[order], units.indices.to_numpy(zero_copy_only=False)[order].astype(np.int64)
        self._weight, self._field = table.column("weight").to_numpy()[order], fields[order]
        self._from = np.searchsorted(self._query, np.arange(len(self.ids) + 1))
        self._by_field = widest and len(np.unique(fields)) > 1
        self.best = TopK(k, len(self.ids))

    def meet(self, rows: pa.Table, ends: np.ndarray) -> None:
        """Let every query see a block of whole documents."""
        if not len(ends):
            return
        unit = pc.index_in(rows.column("unit"), value_set=self._units).combine_chunks()
        known = np.flatnonzero(unit.is_valid().to_numpy(zero_copy_only=False))
        if not len(known):
            return
        document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[known]
        unit = unit.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64)
        part = rows.column("part").to_numpy()[known]
        order = np.argsort(unit, kind="stable")
        document, unit, part = document[order], unit[order], part[order]
        start = np.searchsorted(unit, np.arange(len(self._units) + 1))
        present = np.flatnonzero(start[1:] > start[:-1])
        most = np.full(len(self._units), -1.0)
        most[present] = np.maximum.reduceat(part, start[present])
        reach = most[self._unit] * self._weight
        there = most[self._unit] >= 0
        bound = np.bincount(self._query, np.where(there, reach, 0.0), len(self.ids))
        hopeful = np.bincount(self._query, there, len(self.ids)) > 0
        keys = rows.column("key").combine_chunks().take(pa.array(ends - 1))
        found_query, found_document, found_score = [], [], []
        for q in np.flatnonzero(hopeful & (bound >= -self.best.edge - MARGIN)):
            mine = np.arange(self._from[q], self._from[q + 1])
            mine = mine[there[mine]]
            documents, scores = self._scored(mine, reach, start, document, part, len(ends), -self.best.edge[q] - MARGIN)
            found_query.append(np.full(len(documents), q))
            found_document.append(documents)
            found_score.append(scores)
        if found_query:
            query, documents = np.concatenate(found_query), np.concatenate(found_document)
            self.best.take(query, -np.concatenate(found_score), keys.take(pa.array(documents)))

    def _scored(self, mine, reach, start, document, part, n: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block that reach ``least`` by the terms ``mine``, and their scores."""

        def summed(terms) -> tuple[np.ndarray, np.ndarray]:
            spots = np.concatenate([np.arange(start[self._unit[t]], start[self._unit[t] + 1]) for t in terms])
            weights = np.repeat(self._weight[terms], start[self._unit[terms] + 1] - start[self._unit[terms]])
            return np.bincount(document[spots], part[spots] * weights, n), np.bincount(document[spots], minlength=n) > 0

        if self._by_field:
            score, seen = np.full(n, -1.0), np.zeros(n, bool)
            for f in np.unique(self._field[mine]):
                own, here = summed(mine[self._field[mine] == f])
                score, seen = np.maximum(score, np.where(here, own, -1.0)), seen | here
        else:
            mine = mine[np.argsort(reach[mine], kind="stable")]
            idle = int(np.searchsorted(np.cumsum(reach[mine]), least))  # these alone lift no document to ``least``
            idle = min(idle, len(mine) - 1)
            score, seen = summed(mine[idle:])
            if idle:
                seen &= score + reach[mine[:idle]].sum() >= least
                if not seen.any():
                    return np.zeros(0, np.int64), np.zeros(0)
                more, _ = summed(mine[:idle])
                score = score + more
        documents = np.flatnonzero(seen & (score >= least))
        return documents, score[documents]
