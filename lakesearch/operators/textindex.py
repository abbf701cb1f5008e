"""Term-clustered postings of a document table, written once and read by text searches."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..errors import QueryError
from ..functions.text import term_positions
from ..runtime import broadcast_if_small, computed_once, equi_join
from ..schema import DocumentSchema
from .fulltext import field_tokens

_BUCKET = "_bucket"
_ITSELF = -1  # the folder of documents themselves


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int").alias(_BUCKET)


class TextIndex:
    """Postings with positions, holders per term, and collection statistics on disk, in segments.

    Postings lie in folders by segment and by a hash of their term, sorted by term. A lookup
    reads the folders its terms fall into, and Parquet statistics skip most of each file.
    Every load appends a segment; a document that comes again or is removed is named in the
    newer segment, which hides its older postings, and statistics are sums over the segments
    less what was hidden. A segment counts from the moment its statistics, its last part, are
    written. Keys are unique within a load; one writer at a time. Many small segments make
    searches slower: build anew now and then.
    """

    def __init__(self, spark: SparkSession, path: str, settings: dict):
        self._spark = spark
        self._path = path
        self._key = settings["key"]
        self._settings = settings

    @classmethod
    def build(
        cls,
        df: DataFrame,
        fields: Iterable[str],
        path: str,
        schema: DocumentSchema | None = None,
        stem: bool = False,
        sound: bool = False,
        buckets: int = 64,
    ) -> TextIndex:
        """A new index at ``path``, in place of what is there, with ``df`` as its first segment."""
        key = schema.key if schema is not None else "_key"
        settings = {"key": key, "kind": df.schema[key].dataType.simpleString(), "fields": list(fields), "stem": stem, "sound": sound, "buckets": buckets}
        spark = df.sparkSession
        for part in ("statistics", "superseded", "terms", "postings"):
            spark.createDataFrame([], "empty int").write.mode("overwrite").parquet(f"{path}/{part}")
        spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
        index = cls(spark, path, settings)
        index.append(df, schema, segment=0)
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: DocumentSchema | None = None) -> TextIndex:
        settings = json.loads(spark.read.text(f"{path}/settings").first()[0])
        if schema is not None and schema.key != settings["key"]:
            raise QueryError(f"The index is keyed by {settings['key']!r}, the schema by {schema.key!r}")
        return cls(spark, path, settings)

    def append(self, df: DataFrame, schema: DocumentSchema | None = None, segment: int | None = None) -> int:
        """Add documents; those whose key is known replace the older ones. The number of the segment.

        Reads the batch once and, of the index, only keys and lengths. ``segment`` names the
        last segment again after a failure in between, which then is written anew; without it
        a new one follows.
        """
        options = self._settings
        rows = df.select("*", field_tokens(df, options["fields"], schema, options["stem"], options["sound"])).select(self._key, "field", "_words")
        rows = computed_once(rows, length=F.size("_words"), _terms=term_positions(F.col("_words")))
        rows = computed_once(rows, peak=F.array_max(F.transform("_terms", lambda t: t["tf"])))
        kind = rows.schema["_terms"].dataType.simpleString()
        # A document stands for itself by an empty term, whether it holds words or not.
        itself = F.array(F.struct(F.lit("").alias("term"), F.lit(0).alias("tf"), F.array().alias("positions"))).cast(kind)
        postings = rows.select(self._key, "field", "length", "peak", F.inline(F.concat(itself, F.coalesce("_terms", F.array().cast(kind)))))
        return self._write(postings, None, segment)

    def remove(self, keys: DataFrame, segment: int | None = None) -> int:
        """Take the documents of the ``keys`` (a column named like the index's key) out of the index."""
        return self._write(self._read("postings").where("false").drop("_segment", _BUCKET), keys.select(self._key), segment)

    def _write(self, postings: DataFrame, removed: DataFrame | None, segment: int | None) -> int:
        key, buckets = self._key, self._settings["buckets"]
        last = self._last()
        segment = last + 1 if segment is None else segment
        if not last <= segment <= last + 1:
            raise QueryError(f"Segment {segment} does not follow segment {last}")
        place = {part: f"{self._path}/{part}/_segment={segment}" for part in ("postings", "terms", "superseded", "statistics")}
        postings = postings.withColumn(_BUCKET, F.when(F.col("term") == "", F.lit(_ITSELF)).otherwise(_bucket(F.col("term"), buckets)))
        # Rebalancing splits the bucket of a frequent term into several files.
        postings = postings.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, "term")
        postings.write.mode("overwrite").partitionBy(_BUCKET).parquet(place["postings"])
        own = self._read("postings").where(F.col("_segment") == segment)
        holders = own.where(F.col(_BUCKET) >= 0).groupBy(_BUCKET, "field", "term").agg(F.count(F.lit(1)).alias("holders"))
        holders.write.mode("overwrite").partitionBy(_BUCKET).parquet(place["terms"])
        documents = own.where(F.col(_BUCKET) == _ITSELF)
        keys = documents.select(key) if removed is None else removed
        keys = keys.where(F.col(f"`{key}`").isNotNull()).distinct()
        older = self._live(self._read("postings").where((F.col(_BUCKET) == _ITSELF) & (F.col("_segment") < segment)), segment - 1)
        gone = older.join(broadcast_if_small(keys), key, "left_semi").select(key, "field", "length")
        gone.select(key).distinct().write.mode("overwrite").parquet(place["superseded"])

        def sums(rows: DataFrame, sign: int) -> DataFrame:
            return rows.select("field", F.lit(sign).alias("n"), F.when(F.col("length").isNotNull(), sign).alias("h"), (F.col("length") * sign).alias("l"))

        every = self._spark.createDataFrame([(f, 0, 0, 0) for f in self._settings["fields"]], "field string, n int, h int, l int")
        both = sums(documents, 1).union(sums(gone, -1)).union(every)
        both = both.groupBy("field").agg(F.sum("n").alias("total"), F.sum("h").alias("holding"), F.sum("l").alias("tokens"))
        both.coalesce(1).write.mode("overwrite").parquet(place["statistics"])
        return segment

    def _read(self, part: str) -> DataFrame:
        key = f"`{self._key}` {self._settings['kind']}"
        columns = {
            "postings": f"{key}, field string, length int, peak int, term string, tf int, positions array<int>, _segment int, {_BUCKET} int",
            "terms": f"field string, term string, holders long, _segment int, {_BUCKET} int",
            "superseded": f"{key}, _segment int",
            "statistics": "field string, total long, holding long, tokens long, _segment int",
        }
        # Written with the index, so that a table without any segment can be read.
        return self._spark.read.schema(columns[part]).parquet(f"{self._path}/{part}").where("_segment is not null")

    def _last(self) -> int:
        last = self._read("statistics").agg(F.max("_segment")).first()[0]
        return -1 if last is None else last

    def _live(self, postings: DataFrame, last: int) -> DataFrame:
        """``postings`` up to segment ``last`` that no newer segment up to it hides."""
        postings = postings.where(F.col("_segment") <= last)
        if last < 1:
            return postings
        hidden = self._read("superseded").where(F.col("_segment") <= last).groupBy(self._key).agg(F.max("_segment").alias("_until"))
        marked = postings.join(broadcast_if_small(hidden), self._key, "left")
        return marked.where(F.col("_until").isNull() | (F.col("_segment") >= F.col("_until"))).drop("_until")

    @property
    def postings(self) -> DataFrame:
        """Postings of all documents that are in the index now."""
        return self._live(self._read("postings").where(F.col(_BUCKET) >= 0), self._last()).drop("_segment")

    def lookup(
        self, vocabulary: DataFrame, fields: list[str], stem: bool = False, sound: bool = False
    ) -> tuple[DataFrame, DataFrame, dict[str, float]]:
        """Postings and holders of the wanted terms, phrases included, and the statistics."""
        key, options = self._key, self._settings
        unknown = [f for f in fields if f not in options["fields"]]
        if unknown:
            raise QueryError(f"The index has no field {unknown[0]!r}")
        if (stem, sound) != (options["stem"], options["sound"]):
            raise QueryError(f"The index was built with stem={options['stem']} and sound={options['sound']}, and must be searched so")
        last = self._last()
        rows = self._read("statistics").where(F.col("field").isin(*fields) & (F.col("_segment") <= last)).groupBy("field")
        rows = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "holding", "tokens")]).collect()
        statistics: dict[str, float] = {"total": max((r["total"] for r in rows), default=0)}
        for r in rows:
            statistics[f"mean:{r['field']}"] = r["tokens"] / r["holding"] if r["holding"] else 1.0
        wanted = self._folders(vocabulary, options["buckets"]) & F.col("field").isin(*fields)
        postings = self._read("postings").where(wanted & (F.col("_segment") <= last))
        single = vocabulary.where("words = 1").select("term")
        found = self._live(equi_join(postings.drop("positions"), single, ["term"], F.col(f"`{key}`")), last)
        found = found.select(key, "field", "term", "tf", "length", "peak")
        if last > 0 and not self._read("superseded").where(F.col("_segment") <= last).isEmpty():
            holders = found.groupBy("field", "term").agg(F.count(F.lit(1)).alias("holders"))
        else:
            holders = self._read("terms").where(wanted & (F.col("_segment") <= last))
            holders = equi_join(holders, single, ["term"], F.col("term")).groupBy("field", "term").agg(F.sum("holders").alias("holders"))
        phrases = vocabulary.where("words > 1")
        if not phrases.isEmpty():
            runs = self._phrase_postings(postings, phrases, last)
            found = found.unionByName(runs)
            holders = holders.unionByName(runs.groupBy("field", "term").agg(F.count(F.lit(1)).alias("holders")))
        return found, holders, statistics

    @staticmethod
    def _folders(vocabulary: DataFrame, buckets: int) -> Column:
        """The folders that can hold the wanted words: at most one value per folder is collected."""
        word = vocabulary.select(F.explode(F.split("term", " ")).alias("_word"))
        wanted = [r[0] for r in word.select(_bucket(F.col("_word"), buckets)).distinct().collect()]
        return F.col(_BUCKET).isin(*wanted) if wanted else F.lit(False)

    def _phrase_postings(self, postings: DataFrame, phrases: DataFrame, last: int) -> DataFrame:
        """Runs of consecutive positions: a start counts when every word of the phrase follows it."""
        key = self._key
        parts = phrases.select(
            F.col("term").alias("_phrase"), "words", F.posexplode(F.split("term", " ")).alias("_nth", "term")
        )
        near = self._live(equi_join(postings, parts, ["term"], F.col(f"`{key}`")), last)
        near = near.select(
            key, "field", "_phrase", "words", "length", "peak", F.explode("positions").alias("_at"), "_nth"
        ).withColumn("_start", F.col("_at") - F.col("_nth"))
        runs = near.groupBy(key, "field", "_phrase", "words", "_start").agg(
            F.count(F.lit(1)).alias("_hit"), F.max("length").alias("length"), F.max("peak").alias("peak")
        )
        runs = runs.where("_hit = words")
        return runs.groupBy(key, "field", F.col("_phrase").alias("term")).agg(
            F.count(F.lit(1)).alias("tf"), F.max("length").alias("length"), F.max("peak").alias("peak")
        )
