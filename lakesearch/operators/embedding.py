"""Text to vectors: a model interface run per Arrow batch, and a hashing default."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..checks import positive_int, text_given
from ..errors import QueryError
from ..functions.text import tokens


class Vectorizer(ABC):
    """Turns texts into vectors of a fixed length."""

    @property
    @abstractmethod
    def dims(self) -> int: ...

    @property
    @abstractmethod
    def model(self) -> str: ...

    @abstractmethod
    def embed_column(self, df: DataFrame, text: str, out: str, batch_size: int = 32) -> DataFrame:
        """``df`` with an ``array<float>`` column of the text column's vectors."""

    def embed_many(self, spark: SparkSession, texts: Sequence[str], batch_size: int = 32) -> list[list[float]]:
        """Vectors of a few texts, in order."""
        positive_int(batch_size, "batch_size")
        if not texts:
            return []
        rows = spark.createDataFrame(list(enumerate(texts)), "_pos int, _text string")
        found = self.embed_column(rows, "_text", "_vector", batch_size).orderBy("_pos").collect()
        return [list(r["_vector"]) for r in found]

    def embed(self, spark: SparkSession, text: str) -> list[float]:
        return self.embed_many(spark, [text])[0]


class ModelVectorizer(Vectorizer):
    """A user's model, built once per Python worker by ``build``.

    ``build()`` returns a function from a list of texts to a list of token matrices or
    vectors. Matrices are pooled (``mean`` or ``cls``); vectors are scaled to unit
    length unless ``normalize`` is off.
    """

    def __init__(
        self,
        model: str,
        dims: int,
        build: Callable[[], Callable[[list[str]], Sequence]],
        pooling: str = "mean",
        normalize: bool = True,
    ):
        text_given(model, "model")
        positive_int(dims, "dims")
        if pooling not in ("mean", "cls"):
            raise QueryError(f"pooling must be mean or cls, got {pooling!r}")
        self._model, self._dims, self._build = model, dims, build
        self._pooling, self._normalize = pooling, normalize

    @property
    def dims(self) -> int:
        return self._dims

    @property
    def model(self) -> str:
        return self._model

    def embed_column(self, df: DataFrame, text: str, out: str, batch_size: int = 32) -> DataFrame:
        positive_int(batch_size, "batch_size")
        build, pooling, unit, dims = self._build, self._pooling, self._normalize, self._dims

        @F.arrow_udf(T.ArrayType(T.FloatType()))
        def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import numpy as np

            encode = build()
            for batch in batches:
                texts = batch.to_pylist()
                out_rows: list = [None] * len(texts)
                given = [i for i, t in enumerate(texts) if t is not None]
                for at in range(0, len(given), batch_size):
                    part = given[at : at + batch_size]
                    for i, found in zip(part, encode([texts[i] for i in part])):
                        vector = np.asarray(found, dtype=np.float64)
                        if vector.ndim == 2:
                            vector = vector.mean(axis=0) if pooling == "mean" else vector[0]
                        if vector.shape != (dims,):
                            raise ValueError(f"the model gave {vector.shape} values instead of {dims}")
                        norm = np.sqrt((vector * vector).sum())
                        out_rows[i] = (vector / norm if unit and norm > 0 else vector).astype(np.float32)
                yield pa.array(out_rows, pa.list_(pa.float32()))

        return df.withColumn(out, vectors(F.col(f"`{text}`")))


class HashingVectorizer(Vectorizer):
    """Unit vectors of hashed token counts: no model file, the same on every run, and JVM-side."""

    def __init__(self, dims: int = 256):
        positive_int(dims, "dims")
        self._dims = dims

    @property
    def dims(self) -> int:
        return self._dims

    @property
    def model(self) -> str:
        return f"hashing-{self._dims}"

    def embed_column(self, df: DataFrame, text: str, out: str, batch_size: int = 32) -> DataFrame:
        words = F.coalesce(tokens(F.col(f"`{text}`")), F.array().cast("array<string>"))
        rows = df.withColumn("_words", words)
        counted = HashingTF(numFeatures=self._dims, inputCol="_words", outputCol="_counts").transform(rows)
        scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(counted)
        vector = F.when(F.col(f"`{text}`").isNotNull(), vector_to_array("_unit", "float32"))
        return scaled.withColumn(out, vector).drop("_words", "_counts", "_unit")


def embed(df: DataFrame, text: str, out: str, vectorizer: Vectorizer, batch_size: int = 32) -> DataFrame:
    """``df`` with a vector column computed from a text column, ready to load or to search with."""
    return vectorizer.embed_column(df, text, out, batch_size)
