"""Near-duplicate detection by SimHash fingerprints and the generalised pigeonhole principle.

Fingerprints that differ in at most ``bits`` bits are linked. The 64 bits are grouped
into partitions of correlated bits. Every fingerprint shares its error budget out
among the partitions, unequally: partition i gets a threshold t_i of -1 (skip) or
more with sum(t_i + 1) = bits + 1, so a partner must lie within t_i in some
partition i. A dynamic programme picks the thresholds with the fewest expected
candidates plus probes. A fingerprint probes the values within t_i of its own, and
the join verifies the whole distance before it emits a link.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import computed_once, written
from .common import identity, small, table
from .components import connected

BITS = 64
SEED = 42
PREFIX = 12
CELLS = 200_000
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every ``words``-word shingle of an ASCII-lower-cased text, repeats included.

    A text of fewer words is one shingle, a text without words none.
    """
    found = WORD_BYTES.findall(text.encode("utf-8", "surrogatepass").lower()) if isinstance(text, str) else []
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    reach = min(words, len(found)) - 1
    a, b = starts[: len(found) - reach].tolist(), ends[reach:].tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, a, b)), repeat(SEED)), np.uint64, len(a))


def fingerprint(hashes: np.ndarray) -> int:
    """The signed 64-bit SimHash: a bit is 1 if it is set in over half the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 16384):
        ones += np.unpackbits(hashes[i : i + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_column(text: str, words: int) -> Column:
    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(shingle_hashes(t, words)) for t in texts], dtype="int64")

    return hashed(text)


def hex_digits(fp: Column) -> Column:
    """A signed fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def partition_count(n: int, bits: int) -> int:
    """The number of partitions with the least expected work for ``n`` spread-out fingerprints."""

    def work(m: int) -> float:
        total = 0.0
        for i in range(m):
            width = BITS // m + (i < BITS % m)
            budget = (bits + 1) // m + (i < (bits + 1) % m) - 1
            total += ball(width, budget) * (1 + n / 2**width)
        return total

    return min(range(1, min(bits + 1, BITS) + 1), key=work)


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, k) for k in range(min(radius, width) + 1))


def grouped_bits(ones: np.ndarray, both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """The bits in ``m`` groups of nearly equal width, correlated bits together.

    A group starts with the most correlated free pair and takes the free bit with the
    highest mean absolute correlation until it is full.
    """
    p = ones / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        inner = correlation[np.ix_(free, free)]
        group = [free.pop(int(inner.sum(axis=1).argmax() if width == 1 else np.unravel_index(inner.argmax(), inner.shape)[0]))]
        while len(group) < width:
            group.append(free.pop(int(correlation[np.ix_(free, group)].mean(axis=1).argmax())))
        groups.append(group)
    return groups


def allocated(costs: list[np.ndarray], bits: int) -> np.ndarray:
    """Thresholds (rows x partitions) of least total cost with sum(t + 1) = bits + 1.

    ``costs[i][:, e + 1]`` is the cost of threshold ``e`` in partition ``i``. Ties take
    the smaller threshold in the later partition.
    """
    rows = len(costs[0])
    best = np.full((rows, bits + 2), np.inf)
    best[:, 0] = 0
    picks = []
    for cost in costs:
        grown = np.full_like(best, np.inf)
        pick = np.zeros(best.shape, np.int8)
        for e in range(cost.shape[1]):
            for s in range(e, bits + 2):
                sums = best[:, s - e] + cost[:, e]
                better = sums < grown[:, s]
                grown[better, s] = sums[better]
                pick[better, s] = e
        best = grown
        picks.append(pick)
    out = np.zeros((rows, len(costs)), np.int64)
    left = np.full(rows, bits + 1)
    for i in range(len(costs) - 1, -1, -1):
        taken = picks[i][np.arange(rows), left]
        out[:, i] = taken.astype(np.int64) - 1
        left = left - taken
    return out


class Partitions:
    """The grouping of bits, and histograms of each group's first bits over all fingerprints."""

    def __init__(self, groups: list[list[int]], histograms: np.ndarray, bits: int):
        self.groups, self.bits = groups, bits
        self.near = []  # expected number of fingerprints within each distance of each prefix
        for group, counts in zip(groups, histograms, strict=True):
            shown = min(PREFIX, len(group))
            hidden = len(group) - shown
            rings = [counts[: 1 << shown].astype(float)]
            grid = np.arange(1 << shown)
            for k in range(1, bits + 1):
                masks = masks_of(shown, k, only=True)
                rings.append(sum((rings[0][grid ^ x] for x in masks), np.zeros(1 << shown)))
            share = [math.comb(hidden, k) / 2**hidden for k in range(bits + 1)]
            exact = [sum(rings[k - j] * share[j] for j in range(k + 1)) for k in range(bits + 1)]
            self.near.append(np.cumsum(exact, axis=0).T)

    def values(self, matrix: np.ndarray, i: int) -> np.ndarray:
        out = np.zeros(len(matrix), np.int64)
        for k, bit in enumerate(self.groups[i]):
            out |= matrix[:, bit].astype(np.int64) << k
        return out

    def thresholds(self, values: list[np.ndarray]) -> np.ndarray:
        costs = []
        for i, own in enumerate(values):
            near = self.near[i][own & ((1 << min(PREFIX, len(self.groups[i]))) - 1)]
            probes = np.array([ball(len(self.groups[i]), e) for e in range(self.bits + 1)], float)
            costs.append(np.concatenate([np.zeros((len(own), 1)), near + probes], axis=1))
        return allocated(costs, self.bits)


def masks_of(width: int, radius: int, only: bool = False) -> np.ndarray:
    """All masks of ``width`` bits with at most (or exactly) ``radius`` ones."""
    sizes = [radius] if only else range(min(radius, width) + 1)
    return np.array([sum(1 << b for b in c) for k in sizes for c in combinations(range(width), k)], np.int64)


def partitioned(distinct: DataFrame, bits: int) -> Partitions | None:
    """Bit groups and histograms from all rows of ``distinct`` (``fp``); None if it is empty.

    What reaches the driver is bounded: 64 x 64 counts and 4,096 per partition.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            matrix = bit_matrix(batch["fp"].to_numpy()).astype(np.float32)
            total += matrix.T @ matrix
            n += len(matrix)
        if n:
            yield pd.DataFrame({"i": np.repeat(np.arange(BITS + 1), BITS), "j": np.tile(np.arange(BITS), BITS + 1), "n": np.append(total.ravel(), [n] * BITS).astype(np.int64)})

    counted = distinct.mapInPandas(moments, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return None
    both = np.zeros((BITS + 1, BITS))
    for r in counted:
        both[r["i"], r["j"]] = r["n"]
    n = int(both[BITS, 0])
    groups = grouped_bits(np.diag(both[:BITS]), both[:BITS], n, partition_count(n, bits))
    width = [min(PREFIX, len(g)) for g in groups]

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(groups), 1 << PREFIX), np.int64)
        for batch in batches:
            matrix = bit_matrix(batch["fp"].to_numpy()).astype(np.int64)
            for i, group in enumerate(groups):
                counts[i] += np.bincount(matrix[:, group[: width[i]]] @ (1 << np.arange(width[i])), minlength=1 << PREFIX)
        i, prefix = np.nonzero(counts)
        yield pd.DataFrame({"i": i, "prefix": prefix, "n": counts[i, prefix]})

    histograms = np.zeros((len(groups), 1 << PREFIX), np.int64)
    for r in distinct.mapInPandas(prefixes, "i int, prefix int, n long").groupBy("i", "prefix").agg(F.sum("n").alias("n")).collect():
        histograms[r["i"], r["prefix"]] = r["n"]
    return Partitions(groups, histograms, bits)


def links(distinct: DataFrame, bits: int = 3) -> DataFrame:
    """``a, b`` (a < b) for distinct fingerprints (``fp``) that differ in at most ``bits`` bits.

    Each link is found from its smaller end, at most once per partition, and is
    verified inside the join, so candidates are never emitted.
    """
    plan = partitioned(distinct, bits)
    spark = distinct.sparkSession
    if plan is None:
        return spark.createDataFrame([], "a long, b long")
    shared = spark.sparkContext.broadcast((plan.groups, plan.near, plan.bits))

    def opened() -> Partitions:
        own = Partitions.__new__(Partitions)
        own.groups, own.near, own.bits = shared.value
        return own

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = opened()
        for batch in batches:
            fps = batch["fp"].to_numpy()
            matrix = bit_matrix(fps)
            for i in range(len(own.groups)):
                yield pd.DataFrame({"part": np.int32(i), "value": own.values(matrix, i), "b": fps})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = opened()
        rings: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            fps = batch["fp"].to_numpy()
            matrix = bit_matrix(fps)
            values = [own.values(matrix, i) for i in range(len(own.groups))]
            spent = own.thresholds(values)
            for i, group in enumerate(own.groups):
                for e in range(own.bits + 1):
                    rows = np.flatnonzero(spent[:, i] == e)
                    if not len(rows):
                        continue
                    ring = rings.get((len(group), e))
                    if ring is None:
                        ring = rings[len(group), e] = masks_of(len(group), e)
                    step = max(1, CELLS // len(ring))
                    for at in range(0, len(rows), step):
                        some = rows[at : at + step]
                        yield pd.DataFrame({"part": np.int32(i), "value": (values[i][some, None] ^ ring).ravel(), "a": np.repeat(fps[some], len(ring))})

    left = distinct.select("fp").mapInPandas(probe, "part int, value long, a long")
    right = distinct.select("fp").mapInPandas(index, "part int, value long, b long")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (left["part"] == right["part"]) & (left["value"] == right["value"]) & (F.col("a") < F.col("b")) & (apart <= bits)
    return left.join(right, near).select("a", "b").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3) -> DataFrame:
    """``key, fingerprint, component_id`` for every row of ``df``.

    ``component_id`` is the smallest key among the rows whose fingerprints are reachable
    by links; a row without links is its own component. Null and wordless texts have
    fingerprint zero and link like any other. Equal texts share a fingerprint and are
    one node. Null keys are never chosen unless a component has no other.
    """
    spark = df.sparkSession
    rows = computed_once(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")), _fp=fingerprint_column("_text", words))
    rows = written(rows.select("_key", F.col("_fp").alias("fp")), "fingerprints")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = written(rows.groupBy("fp").agg(F.min("_key").alias("first")).repartition(parts), "fingerprints")
    roots = connected(links(distinct.select("fp"), bits))
    grouped = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = grouped.select("fp", "root").join(firsts, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(F.col("_key").alias(key), hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def simhash_components(spark, folder: str) -> DataFrame:
    """op6: fingerprint and component of every document."""
    return near_duplicates(table(spark, folder, "documents"))


def sketch(text: str | None, words: int, size: int = 128) -> np.ndarray:
    """The smallest distinct shingle hashes of a text, signed, sorted."""
    return np.unique(shingle_hashes(text, words))[:size].view(np.int64)


def resemblance(a: np.ndarray, b: np.ndarray, size: int = 128) -> float:
    """Jaccard similarity of two shingle sets from their sketches; exact for sets of up to ``size``.

    Two empty sets are equal.
    """
    one, two = a.view(np.uint64), b.view(np.uint64)
    both = np.union1d(one, two)[:size]
    return 1.0 if not len(both) else float(np.isin(both, np.intersect1d(one, two)).mean())


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of distinct values; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def alike(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The ``u, v`` of ``pairs`` whose texts (``t, _text``) have ``words``-word shingle sets of similarity ``least``.

    Sketches drop what is far off, by four times their error; the full sets decide.
    """
    size = 128

    @F.pandas_udf("array<long>")
    def sketched(found: pd.Series) -> pd.Series:
        return pd.Series([sketch(x, words, size) for x in found], dtype=object)

    @F.pandas_udf("array<long>")
    def whole(found: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(x, words)).view(np.int64) for x in found], dtype=object)

    @F.pandas_udf("boolean")
    def perhaps(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([resemblance(x, y, size) >= least - 0.15 for x, y in zip(one, two, strict=True)], dtype=bool)

    @F.pandas_udf("boolean")
    def surely(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([jaccard(x, y) >= least for x, y in zip(one, two, strict=True)], dtype=bool)

    for made, kept in ((sketched, perhaps), (whole, surely)):
        nodes = written(pairs.select(F.col("u").alias("t")).union(pairs.select("v")).distinct(), "nodes")
        sets = written(texts.join(small(nodes), "t", "left_semi").dropDuplicates(["t"]).select("t", made("_text").alias("set")), "sets")
        left, right = sets.toDF("u", "one"), sets.toDF("v", "two")
        pairs = written(pairs.join(left, "u").join(right, "v").where(kept("one", "two")).select("u", "v"), "alike")
    return pairs


# Rounds in which texts of one fingerprint meet one of them; the rest then meet each other.
LEADERS = 3


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 11, similar_words: int = 5, least: float = 0.8) -> DataFrame:
    """``df`` with one row of each group of near duplicates: that of the smallest key, null keys last.

    Fingerprints of ``words``-word shingles propose links within ``bits`` bits; a link
    counts if the texts' ``similar_words``-word shingle sets also have a Jaccard
    similarity of ``least``. Different texts of one fingerprint are compared with one of
    them, and where that fails, with one of the rest. Null and wordless texts are one
    group. Of rows with equal key and text one stays.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filled = df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).withColumn("_doc", identity(key, "_text"))
    named = filled.select("_doc", F.col(key).alias("_key"), "_text", F.unhex(F.md5("_text")).alias("t"))
    rows = computed_once(named, _fp=fingerprint_column("_text", words))
    rows = written(rows.select("_doc", "_key", "t", F.col("_fp").alias("fp")), "fingerprints")
    texts = named.select("t", "_text")
    place = F.struct(F.col("_key").isNull().alias("last"), F.col("_key").alias("key"), F.col("_doc").alias("doc"))
    distinct = written(rows.groupBy("t", "fp").agg(F.min(place).alias("first"), F.count("*").alias("n")).repartition(parts), "texts")
    leaders, found = [], []
    left = distinct.select("t", "fp")
    for _ in range(LEADERS):
        lead = written(left.groupBy("fp").agg(F.min("t").alias("u"), F.count("*").alias("_texts")), "leaders")
        leaders.append(lead.select("fp", "u"))
        met = left.join(lead.where("_texts > 1").select("fp", "u"), "fp").where("t != u").select("fp", "u", F.col("t").alias("v"))
        met = written(met, "met")
        near = alike(met.select("u", "v"), texts, similar_words, least)
        found.append(near)
        left = written(met.join(near, ["u", "v"], "left_anti").select(F.col("v").alias("t"), "fp"), "left")
        if left.isEmpty():
            break
    else:
        rest = left.select("fp", F.col("t").alias("u"))
        leaders.append(rest)
        met = rest.join(left.select("fp", F.col("t").alias("v")), "fp").where("u < v").select("u", "v")
        found.append(alike(written(met, "met"), texts, similar_words, least))
    led = leaders[0]
    for more in leaders[1:]:
        led = led.union(more)
    led = written(led, "leaders")
    close = written(links(distinct.select("fp").distinct(), bits), "links")
    between = close.join(led.toDF("a", "u"), "a").join(led.toDF("b", "v"), "b").select("u", "v")
    # Those of one fingerprint that are led by different texts have met already.
    met = alike(written(between, "met"), texts, similar_words, least)
    for more in found:
        met = met.union(more)
    roots = connected(met, "u", "v")
    grouped = distinct.join(roots, F.col("t") == F.col("node"), "left").where("n > 1 or root is not null").select("t", "first", F.coalesce("root", "t").alias("root"))
    grouped = written(grouped, "groups")
    kept = grouped.select("t", "root").join(grouped.groupBy("root").agg(F.min("first").alias("first")), "root").select("t", F.col("first.doc").alias("_kept"))
    gone = written(rows.join(small(written(kept, "groups")), "t").where("_doc != _kept").select("_doc").distinct(), "copies")
    stay = filled.join(small(gone), "_doc", "left_anti")
    if rows.count() > rows.select("_doc").distinct().count():
        stay = stay.dropDuplicates(["_doc"])
    return stay.select(*[F.col(f"`{c}`") for c in df.columns])


def simhash_stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)
