"""Approximate nearest neighbours by cosine: an adaptive dimension scan inside probed lists.

Unit vectors are turned by one random rotation, so that any few coordinates are a fair
sample of a distance, and split into lists around k-means centroids. A query probes
its nearest lists, as many as a calibration against exact neighbours asks for. Within
a list the coordinates lie in column blocks: after each block a hypothesis test
abandons the candidates whose distance so far, scaled up, is too large to end up below
the query's bound. What survives all blocks is ranked by the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import written
from .common import small, table

BLOCK_DIMS = 16
DOUBT = 2.1
SAMPLE_ROWS = 20_000
CALIBRATION_QUERIES = 100
TARGET = 0.97
MOST_LISTS = 1024
BLOCK_ROWS = 4096
CHUNK_QUERIES = 512
SPARE = 5
SEED = 42


@dataclass(frozen=True)
class Scan:
    """Rotation, centroids (rotated, unit length), a sample of rotated vectors and the number of lists to probe."""

    rotation: np.ndarray
    centroids: np.ndarray
    sample: np.ndarray
    probes: int


def unit(vectors: pd.Series) -> np.ndarray:
    """Vectors scaled to length one in double precision; by their largest component first, so none overflows."""
    rows = np.stack(vectors.to_numpy()).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def adaptive_scan(queries: np.ndarray, vectors: np.ndarray, bounds: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, vector row, squared distance)`` of up to ``keep`` nearest vectors of each query.

    ``bounds`` are squared distances that the answer need not exceed; each is lowered to
    the farthest of the ``keep`` vectors that look best after the first column block.
    A candidate goes when its partial distance, scaled to all dimensions, exceeds the
    bound by more than the test's margin for the dimensions seen.
    """
    dims = queries.shape[1]
    cuts = [slice(at, min(at + BLOCK_DIMS, dims)) for at in range(0, dims, BLOCK_DIMS)]
    columns = [np.ascontiguousarray(vectors[:, c]) for c in cuts]
    asked = [np.ascontiguousarray(queries[:, c]) for c in cuts]
    first = (asked[0] ** 2).sum(1)[:, None] + (columns[0] ** 2).sum(1) - 2 * asked[0] @ columns[0].T
    if len(vectors) <= keep:
        q, v = np.divmod(np.arange(len(queries) * len(vectors)), len(vectors))
        return q, v, ((queries[q] - vectors[v]) ** 2).sum(1)
    near = np.argpartition(first, keep - 1, axis=1)[:, :keep]
    reached = ((queries[:, None, :] - vectors[near]) ** 2).sum(2).max(1)
    bounds = np.minimum(bounds, reached)
    sure = np.zeros(first.shape, bool)
    np.put_along_axis(sure, near, True, axis=1)
    seen = cuts[0].stop
    q, v = np.nonzero((first * (dims / seen) <= _limit(bounds, seen, dims)[:, None]) | sure)
    distance, safe = first[q, v], sure[q, v]
    for block, cut in enumerate(cuts[1:], 1):
        distance = distance + ((asked[block][q] - columns[block][v]) ** 2).sum(1)
        seen = cut.stop
        stay = (distance * (dims / seen) <= _limit(bounds, seen, dims)[q]) | safe
        q, v, distance, safe = q[stay], v[stay], distance[stay], safe[stay]
    order = np.lexsort((v, distance, q))
    q, v, distance = q[order], v[order], distance[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < keep], v[place < keep], distance[place < keep]


def _limit(bounds: np.ndarray, seen: int, dims: int) -> np.ndarray:
    margin = 1.0 if seen >= dims else (1 + DOUBT / np.sqrt(seen)) ** 2
    return bounds * margin * (1 + 1e-9) + 1e-12


def _centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means; an empty list keeps its centroid."""
    rng = np.random.default_rng(SEED)
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(8):
        own = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        norm = np.linalg.norm(sums, axis=1)
        centroids[norm > 1e-9] = sums[norm > 1e-9] / norm[norm > 1e-9, None]
    return centroids


def fitted(distinct: DataFrame, k: int) -> Scan | None:
    """A scan over ``distinct`` (``gid, vector``); None if it is empty.

    Centroids come from about ``SAMPLE_ROWS`` vectors. The probes are the fewest that
    hold ``TARGET`` of the exact ``k`` nearest of about ``CALIBRATION_QUERIES`` vectors,
    found against all rows, so they follow the size and shape of the data.
    """
    n = distinct.count()
    if not n:
        return None
    drawn = lambda most, salt: F.pmod(F.xxhash64("gid", F.lit(salt)), F.lit(1_000_000)) < F.lit(min(1.0, most / n) * 1_000_000)
    found = distinct.where(drawn(SAMPLE_ROWS, "sample")).select("gid", "vector").toPandas().sort_values("gid")
    if found.empty:
        found = distinct.orderBy("gid").limit(1).select("gid", "vector").toPandas()
    dims = len(found["vector"].iloc[0])
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))[0]
    sample = unit(found["vector"]) @ rotation
    lists = int(min(MOST_LISTS, max(1, round(np.sqrt(n))), len(sample)))
    centroids = _centroids(sample, lists)
    tried = distinct.where(drawn(CALIBRATION_QUERIES, "calibration")).select("gid", "vector").toPandas()
    if tried.empty:
        return Scan(rotation, centroids, sample, lists)
    asked, keep = unit(tried["vector"]) @ rotation, k + 1
    shared = distinct.sparkSession.sparkContext.broadcast((asked, rotation, centroids))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, turn, middles = shared.value
        for batch in batches:
            vectors = unit(batch["vector"]) @ turn
            nearness = queries @ vectors.T
            top = np.argsort(-nearness, axis=1, kind="stable")[:, :keep]
            own = (vectors @ middles.T).argmax(1)
            q = np.repeat(np.arange(len(queries)), top.shape[1])
            yield pd.DataFrame({"q": q, "score": nearness[q, top.ravel()], "list": own[top.ravel()]})

    best = Window.partitionBy("q").orderBy(F.desc("score"), "list")
    truth = distinct.mapInPandas(exact, "q int, score double, list int").withColumn("at", F.row_number().over(best)).where(F.col("at") <= keep).toPandas()
    ranks = np.argsort(np.argsort(-(asked @ centroids.T), axis=1), axis=1)
    needed = np.sort(ranks[truth["q"].to_numpy(), truth["list"].to_numpy()])
    probes = int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))) - 1)]) + 1
    return Scan(rotation, centroids, sample, probes)


def neighbours(df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """``query_id, rank, key, score``: each query's ``k`` nearest rows found, nearest first, ties to the smaller key.

    ``queries`` has the columns of ``df``; a row is no neighbour of a query with its own
    key. Null, zero and non-finite vectors and null keys take no part, as rows or as queries. Vectors
    of each length are searched on their own, with an index for each. Equal vectors are one candidate whose
    smallest keys are kept. With fewer than ``k`` other rows a query gets all of them.
    """
    spark = df.sparkSession
    of = lambda rows: rows.select(F.col(key).alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows, asked = of(df), of(queries)
    lengths = [r["size"] for r in asked.select(F.size("vector").alias("size")).distinct().orderBy("size").collect()]
    kind = df.schema[key].dataType.simpleString()
    out = spark.createDataFrame([], f"query_id {kind}, rank int, {key} {kind}, score double")
    for i, size in enumerate(lengths):
        found = _of_one_length(rows.where(F.size("vector") == size), asked.where(F.size("vector") == size), key, k)
        out = found if i == 0 else out.unionByName(found)
    return out


def _of_one_length(rows: DataFrame, asked: DataFrame, key: str, k: int) -> DataFrame:
    """``neighbours`` for ``id, vector`` with vectors of one length."""
    spark = rows.sparkSession
    first = Window.partitionBy("vector").orderBy("id")
    rows = rows.distinct().withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
    distinct = rows.groupBy("vector").agg(F.min("id").alias("gid"), F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = written(distinct.select("gid", "ids", "vector"), "vectors")
    members = written(asked.join(distinct.select("vector", "gid"), "vector").select("id", "gid").distinct(), "queries")
    scan = fitted(distinct, k)
    keep = k + 1 + SPARE
    shared = spark.sparkContext.broadcast((scan.rotation, scan.centroids, scan.sample, scan.probes))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, middles, _, _ = shared.value
        for batch in batches:
            turned = unit(batch["vector"]) @ turn
            yield pd.DataFrame({"list": (turned @ middles.T).argmax(1).astype(np.int32), "gid": batch["gid"], "turned": list(turned)})

    index = written(distinct.mapInPandas(listed, f"list int, gid {distinct.schema['gid'].dataType.simpleString()}, turned array<double>"), "lists")
    sizes = np.zeros(len(scan.centroids), np.int64)
    for r in index.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    held = spark.sparkContext.broadcast(sizes)

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, middles, sample, probes = shared.value
        full = held.value
        for batch in batches:
            for at in range(0, len(batch), CHUNK_QUERIES):
                part = batch.iloc[at : at + CHUNK_QUERIES]
                turned = unit(part["vector"]) @ turn
                order = np.argsort(-(turned @ middles.T), axis=1, kind="stable")
                enough = (np.cumsum(full[order], axis=1) < keep).sum(1) + 1  # so many lists hold ``keep`` rows
                bounds = np.full(len(part), 4.0)
                if len(sample) >= keep:
                    bounds = 2 - 2 * np.partition(turned @ sample.T, len(sample) - keep, axis=1)[:, len(sample) - keep]
                for i, gid in enumerate(part["gid"]):
                    lists = order[i, : max(probes, min(enough[i], len(full)))]
                    lists = lists[full[lists] > 0]
                    yield pd.DataFrame({"list": lists.astype(np.int32), "gid": gid, "turned": [turned[i]] * len(lists), "bound": max(bounds[i], 0.0)})

    vectors = distinct.join(members.select("gid").distinct(), "gid", "left_semi")
    asks = written(vectors.mapInPandas(probed, f"list int, gid {distinct.schema['gid'].dataType.simpleString()}, turned array<double>, bound double"), "probes")
    asks_of = {r["list"]: r["count"] for r in asks.groupBy("list").count().collect()}
    plan = spark.createDataFrame([(i, int(-(-sizes[i] // BLOCK_ROWS)), -(-n // CHUNK_QUERIES)) for i, n in asks_of.items()] or [(0, 1, 1)], "list int, blocks int, chunks int")
    blocks = index.join(F.broadcast(plan), "list").select(
        "list", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "gid", "turned"
    )
    chunks = asks.join(F.broadcast(plan), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("gid"), F.col("chunks")).cast("int").alias("chunk"), "gid", "turned", "bound"
    )

    def met(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        if one.empty or two.empty:
            return pd.DataFrame({"query": one["gid"].iloc[:0], "gid": two["gid"].iloc[:0], "distance": np.zeros(0)})
        q, v, distance = adaptive_scan(np.stack(one["turned"].to_numpy()), np.stack(two["turned"].to_numpy()), one["bound"].to_numpy(), keep)
        return pd.DataFrame({"query": one["gid"].to_numpy()[q], "gid": two["gid"].to_numpy()[v], "distance": distance})

    cell = ["list", "block", "chunk"]
    kind = distinct.schema["gid"].dataType.simpleString()
    near = chunks.groupBy(*cell).cogroup(blocks.groupBy(*cell)).applyInPandas(met, f"query {kind}, gid {kind}, distance double")
    nearest = Window.partitionBy("query").orderBy("distance", "gid")
    near = near.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= keep).select("query", "gid")

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=float)
        x, y = np.stack(a.to_numpy()).astype(np.float64), np.stack(b.to_numpy()).astype(np.float64)
        x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
        return pd.Series((x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))))

    near = near.join(distinct.select("gid", "ids", F.col("vector").alias("to")), "gid").join(distinct.select(F.col("gid").alias("query"), F.col("vector").alias("of")), "query")
    near = near.select("query", cosine("of", "to").alias("score"), F.explode("ids").alias("found"))
    closest = Window.partitionBy("query").orderBy(F.desc("score"), "found")
    near = written(near.withColumn("at", F.row_number().over(closest)).where(F.col("at") <= k + 1), "nearest")
    each = members.join(small(near), members["gid"] == near["query"]).where("found != id")
    own = Window.partitionBy("id").orderBy(F.desc("score"), "found")
    ranked = each.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("found").alias(key), "score")


def nearest_embeddings(spark, folder: str) -> DataFrame:
    """op3: the five nearest embeddings of every fiftieth one."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours(rows, rows.where("vec_id % 50 = 0"))
