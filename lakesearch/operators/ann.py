"""Approximate nearest neighbours: inverted-file lists and hash bands on Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..checks import positive_int, unit_interval
from ..errors import QueryError
from ..functions.distance import vector_matrix
from ..functions.hashing import Bands
from ..functions.predicates import FilterInput, filtered
from ..runtime import computed_once, with_documents
from ..schema import DocumentSchema
from .search import project_fields
from .vectors import DEFAULT_ALIAS, batch_search, check_policy, knn, search_metric, vector_name, with_score


class IvfIndex:
    """Documents stored by the list of their nearest centroid.

    A search reads the ``nprobe`` lists nearest to the query (partition pruning) and
    ranks their rows by the exact distance, so ``nprobe`` trades speed for recall and
    ``nprobe == nlist`` is exact.
    """

    def __init__(self, spark: SparkSession, path: str, field: str, metric: str, key: str, schema: DocumentSchema | None):
        self._spark = spark
        self._path = path
        self._field = field
        self._metric = metric
        self._key = key
        self._schema = schema
        rows = spark.read.parquet(f"{path}/centroids").orderBy("list_id").collect()
        self._ids = np.array([r["list_id"] for r in rows], dtype=np.int64)
        self._centroids = np.array([r["centroid"] for r in rows], dtype=np.float64)

    @property
    def nlist(self) -> int:
        return len(self._ids)

    @property
    def table(self) -> DataFrame:
        return self._spark.read.parquet(f"{self._path}/rows")

    @classmethod
    def build(
        cls,
        df: DataFrame,
        field: str,
        path: str,
        nlist: int,
        metric: str | None = None,
        seed: int = 17,
        iterations: int = 10,
        schema: DocumentSchema | None = None,
        dims: int | None = None,
        training_rows: int | None = None,
    ) -> IvfIndex:
        """Cluster the vectors, then store every row under its list.

        Training reads all usable rows; ``training_rows`` asks for a sample of about so
        many instead. Without a schema or ``dims`` the most frequent length counts, and
        vectors of other lengths, which no distance to it is defined for, are left out.
        """
        positive_int(nlist, "nlist")
        positive_int(dims, "dims")
        positive_int(training_rows, "training_rows")
        metric = search_metric(schema, field, metric)
        key = schema.key if schema is not None else "_key"
        column = vector_name(schema, field)
        vector = F.col(f"`{column}`")
        spec = schema.field(field) if schema is not None else None
        dims = dims or (spec.dims if spec is not None else common_length(df, vector))
        usable = df.where((F.size(vector) == dims) & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v)))
        training = _units(usable, vector, metric)
        if training_rows is not None and (total := usable.count()) > training_rows:
            training = training.sample(fraction=training_rows / total, seed=seed)
        if nlist == 1:
            means = [F.avg(F.col("features")[i]) for i in range(dims)]
            centers = np.array([[v or 0.0 for v in training.agg(*means).first()]])
        else:
            model = KMeans(k=nlist, seed=seed, maxIter=iterations).fit(training.select(array_to_vector("features").alias("features")))
            centers = np.array(model.clusterCenters())
        table = pa.table({"list_id": pa.array(range(len(centers)), pa.int32()), "centroid": pa.array(list(centers))})
        spark = df.sparkSession
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        assigned = usable.withColumn("list_id", _nearest(vector, spark, centers, metric, 1)[0])
        # Rebalancing lets adaptive execution split a list that holds a large share of the rows.
        assigned.hint("rebalance", "list_id").write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/rows")
        return cls(spark, path, field, metric, key, schema)

    @classmethod
    def open(
        cls, spark: SparkSession, path: str, field: str, metric: str | None = None, schema: DocumentSchema | None = None
    ) -> IvfIndex:
        key = schema.key if schema is not None else "_key"
        return cls(spark, path, field, search_metric(schema, field, metric), key, schema)

    def search(
        self,
        vector: Sequence[float] | None = None,
        k: int = 10,
        nprobe: int | None = None,
        where: FilterInput = None,
        fields: Iterable[str] | None = None,
        offset: int | None = None,
        limit: int | None = None,
        alias: str = DEFAULT_ALIAS,
        normalize: bool = False,
        policy: str | None = None,
        batch_size: int | None = None,
        queries: DataFrame | None = None,
        query_id: str = "query_id",
        query_vector: str = "vector",
    ) -> DataFrame:
        """Nearest neighbours among the probed lists.

        ``policy='ADHOC_BF'`` filters the whole table first and ranks exactly.
        ``policy='BATCHES'`` probes ``batch_size`` lists at a time until ``k`` filtered
        rows are found or every list was read.
        """
        positive_int(k, "k")
        positive_int(nprobe, "nprobe")
        check_policy(policy, batch_size)
        nprobe = min(nprobe or max(1, self.nlist // 8), self.nlist)
        options = dict(
            field=self._field, k=k, where=where, fields=fields, metric=self._metric, alias=alias, normalize=normalize,
            schema=self._schema,
        )
        if queries is not None:
            return self._search_many(queries, nprobe, options, query_id, query_vector)
        options |= dict(offset=offset, limit=limit)
        table = self.table
        if policy == "ADHOC_BF":
            return knn(table.drop("list_id"), vector, **options)
        ranked = self._ranked_lists(vector)
        if policy == "BATCHES":
            step = min(batch_size or nprobe, self.nlist)
            nprobe = self._widened(ranked, step, k, where)
        probed = table.where(F.col("list_id").isin(*ranked[:nprobe])).drop("list_id")
        return knn(probed, vector, **options)

    def calibrate(
        self,
        queries: DataFrame,
        k: int = 10,
        recall: float = 0.95,
        where: FilterInput = None,
        query_id: str = "query_id",
        query_vector: str = "vector",
    ) -> int:
        """The fewest lists to probe so that ``recall`` of the true ``k`` neighbours of ``queries`` are found.

        The neighbours are exact, over all rows that pass ``where``, so pass a sample of the queries to come. Only
        a count for each rank of lists reaches the driver.
        """
        positive_int(k, "k")
        unit_interval(recall, "recall")
        table, key = self.table, self._key
        exact = knn(table.drop("list_id"), field=self._field, k=k, where=where, fields=[], metric=self._metric, schema=self._schema, queries=queries, query_id=query_id, query_vector=query_vector)
        order = _nearest(F.col(f"`{query_vector}`"), self._spark, self._centroids, self._metric, self.nlist)
        ranked = queries.select(query_id, order.alias("_order"))
        found = exact.select(query_id, key).join(table.select(key, "list_id"), key).join(ranked, query_id)
        counts = {r["rank"]: r["n"] for r in found.groupBy(F.array_position("_order", F.col("list_id")).alias("rank")).agg(F.count("*").alias("n")).collect()}
        held, total = 0, sum(counts.values())
        for rank in sorted(counts):
            held += counts[rank]
            if held >= recall * total:
                return int(rank)
        return self.nlist

    def _widened(self, ranked: list[int], step: int, k: int, where: FilterInput) -> int:
        """Lists to read until ``k`` rows pass the filter, growing geometrically."""
        nprobe = step
        while nprobe < self.nlist:
            probed = self.table.where(F.col("list_id").isin(*ranked[:nprobe]))
            if filtered(probed, where, self._schema).limit(k).count() >= k:
                break
            nprobe = min(nprobe * 2, self.nlist)
        return nprobe

    def _ranked_lists(self, vector: Sequence[float] | None) -> list[int]:
        if vector is None or len(vector) == 0:
            raise QueryError("Vector cannot be empty")
        q = np.asarray(vector, dtype=np.float64).reshape(1, -1)
        order = np.argsort(_affinity(q, self._centroids, self._metric)[0], kind="stable")
        return [int(i) for i in self._ids[order]]

    def _search_many(
        self, queries: DataFrame, nprobe: int, options: dict, query_id: str, query_vector: str
    ) -> DataFrame:
        vector = F.col(f"`{query_vector}`")
        probes = _nearest(vector, self._spark, self._centroids, self._metric, nprobe)
        probed = queries.select(query_id, query_vector, probes.alias("_probes")).where(F.col("_probes").isNotNull())
        # At most nlist values, used to prune the lists nobody asks for.
        lists = [r[0] for r in probed.select(F.explode("_probes")).distinct().collect()]
        table = self.table.where(F.col("list_id").isin(*lists)) if lists else self.table.limit(0)
        source = filtered(table, options["where"], self._schema)
        column, key, alias = vector_name(self._schema, self._field), self._key, options["alias"]
        hits = batch_search(
            source, probed, column, self._metric, key, query_id, query_vector,
            k=options["k"], alias=alias, cell="list_id", probes="_probes",
        ).drop("rank")
        if options["fields"]:
            wide = project_fields(source, self._schema, options["fields"])
            hits = with_documents(wide, hits, key, queries.count() * options["k"])
            hits = hits.select(query_id, key, *[c for c in wide.columns if c != key], alias)
        return with_score(hits, alias, self._metric) if options["normalize"] else hits


def common_length(df: DataFrame, vector: Column) -> int:
    """The most frequent vector length, the smaller of equally frequent ones; 1 without vectors."""
    lengths = df.where(vector.isNotNull()).groupBy(F.size(vector).alias("length")).count()
    found = lengths.where("length > 0").orderBy(F.desc("count"), "length").first()
    return found["length"] if found else 1


def _units(df: DataFrame, vector: Column, metric: str) -> DataFrame:
    """``features``: the vectors, under the cosine at length one."""
    doubles = vector.cast("array<double>")
    if metric != "COSINE":
        return df.select(doubles.alias("features"))
    # The norm is computed before, or it would be for every element.
    rows = computed_once(df.select(doubles.alias("_doubles")), _norm=F.sqrt(F.aggregate("_doubles", F.lit(0.0), lambda a, v: a + v * v)))
    return rows.select(F.transform("_doubles", lambda v: F.coalesce(F.try_divide(v, F.col("_norm")), F.lit(0.0))).alias("features"))


def _affinity(x: np.ndarray, centers: np.ndarray, metric: str) -> np.ndarray:
    """Squared distance to each centroid, or the negative product where direction or product decides."""
    if metric == "L2":
        return (centers * centers).sum(axis=1)[None, :] - 2.0 * (x @ centers.T)
    scale = np.sqrt((centers * centers).sum(axis=1)) if metric == "COSINE" else 1.0
    return -(x @ centers.T) / np.where(scale == 0, 1.0, scale)


def _nearest(vector: Column, spark: SparkSession, centers: np.ndarray, metric: str, count: int) -> Column:
    """``array<int>`` of the ``count`` nearest centroids, nearest first; null for unusable vectors."""
    shared = spark.sparkContext.broadcast(centers)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest(v: pa.Array) -> pa.Array:
        centroids = shared.value
        x, rows = vector_matrix(v, centroids.shape[1])
        lists: list[list[int] | None] = [None] * len(v)
        for at in range(0, len(x), 4096):
            near = _affinity(x[at : at + 4096], centroids, metric)
            top = np.argsort(near, axis=1, kind="stable")[:, :count] if count > 1 else near.argmin(axis=1)[:, None]
            for i, ids in zip(rows[at : at + 4096], top.tolist()):
                lists[i] = ids
        return pa.array(lists, pa.list_(pa.int32()))

    return nearest(vector)


class LshIndex:
    """Vectors stored once per hash band, sorted by hash.

    A search reads, per band, the row groups that hold the query's hash, and ranks the
    rows found by the exact distance. There is nothing to train.
    """

    def __init__(self, df: DataFrame, path: str, field: str, bands: Bands, schema: DocumentSchema | None):
        self._df = df
        self._path = path
        self._field = field
        self._bands = bands
        self._schema = schema
        self._key = schema.key if schema is not None else "_key"

    @classmethod
    def build(
        cls, df: DataFrame, field: str, path: str, bands: Bands | None = None, schema: DocumentSchema | None = None
    ) -> LshIndex:
        metric = search_metric(schema, field, bands.metric if bands else None)
        bands = bands or Bands(16, 8, metric)
        key = schema.key if schema is not None else "_key"
        vector = F.col(f"`{vector_name(schema, field)}`")
        spec = schema.field(field) if schema is not None else None
        dims = spec.dims if spec is not None else common_length(df, vector)
        signed = df.select(key, vector.alias("_v"), bands.column(vector, dims).alias("_signature"))
        signed = signed.where(F.col("_signature").isNotNull())
        rows = signed.select(key, "_v", F.posexplode("_signature").alias("_band", "_hash"))
        rows = rows.repartitionByRange("_band", "_hash", F.col(f"`{key}`")).sortWithinPartitions("_band", "_hash")
        rows.write.mode("overwrite").partitionBy("_band").parquet(path)
        return cls(df, path, field, bands, schema)

    def search(
        self,
        vector: Sequence[float],
        k: int = 10,
        where: FilterInput = None,
        fields: Iterable[str] | None = None,
        alias: str = DEFAULT_ALIAS,
        normalize: bool = False,
    ) -> DataFrame:
        """Nearest neighbours among the rows that share at least one band hash with the query."""
        positive_int(k, "k")
        if vector is None or len(vector) == 0:
            raise QueryError("Vector cannot be empty")
        hashes = self._bands.hashes(np.asarray(vector, dtype=np.float64).reshape(1, -1))[0].tolist()
        same = [(F.col("_band") == b) & (F.col("_hash") == h) for b, h in enumerate(hashes)]
        found = self._df.sparkSession.read.parquet(self._path).where(reduce(lambda a, b: a | b, same))
        found = found.groupBy(self._key).agg(F.first("_v").alias("_v"))
        if where is not None:
            allowed = filtered(self._df, where, self._schema).select(self._key)
            found = found.join(allowed, self._key, "left_semi")
        key_only = DocumentSchema("rows", key=self._key)
        hits = knn(found, vector, "_v", k=k, fields=[], metric=self._bands.metric, alias=alias, schema=key_only)
        if fields is None or list(fields):
            wide = project_fields(self._df, self._schema, fields)
            hits = with_documents(wide, hits, self._key, k)
            hits = hits.select(*wide.columns, alias).orderBy(alias, self._key)
        return with_score(hits, alias, self._bands.metric) if normalize else hits
