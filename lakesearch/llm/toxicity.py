"""Toxicity by a character n-gram linear classifier with naive Bayes log-count ratios.

A text is the set of its hashed character n-grams, scaled to length one. Each n-gram
is weighted by the log ratio of its smoothed share among toxic and among clean texts,
and a logistic regression with L2 penalty is fitted on these scaled features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import computed_once
from .common import in_fold, table, with_columns

ORDERS = (3, 4, 5)
BUCKET_BITS = 20
THRESHOLD = 0.7
STEPS = 60
RATE = 0.3
PENALTY = 1e-6
ROWS = 250


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` by n-gram bucket (already scaled by the log-count ratio) and the intercept."""

    weights: np.ndarray
    intercept: float


def grams(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's n-grams: lower case, white space runs as one space, one at each end.

    A null or blank text has none.
    """
    words = text.lower().split() if isinstance(text, str) else []
    if not words:
        return np.zeros(0, np.int32)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashed, found = codes, []
    for n in range(2, max(ORDERS) + 1):
        if len(codes) < n:
            break
        hashed = hashed[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in ORDERS:
            mixed = hashed * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            found.append((mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    return np.unique(np.concatenate(found))


def sampled(labels: DataFrame, key: str = "doc_id", label: str = "toxic", toxic_rows: int = 1000, clean_rows: int = 2000) -> tuple[DataFrame, float | None]:
    """A bounded sample of the labels, and the share of toxic ones among all; their expected numbers are parameters.

    The sample is drawn by a hash of the key, the same in every run. Null keys and labels
    other than 0 and 1 are left out. The share is None without labels.
    """
    rows = labels.select(key, F.col(label).cast("int").alias(label)).where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    size = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    share = F.when(F.col(label) == 1, F.lit(toxic_rows / max(toxic, 1))).otherwise(F.lit(clean_rows / max(clean, 1)))
    sample = rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share * 1_000_000)
    return sample, toxic / (toxic + clean) if size else None


def train(labelled: DataFrame, text: str = "text", label: str = "toxic", share: float | None = None) -> ToxicityModel:
    """Fit on all labelled rows, so give it a bounded sample (see ``sampled``).

    ``share`` is the toxic share among all labels, where the sample's is another. Texts
    are used whole; only their n-gram buckets reach the driver. Rows whose label is not
    0 or 1 or whose text is null teach nothing. With one class only, every text gets the
    smoothed share of toxic rows; with no rows, one half.
    """
    sample = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("toxic")).where("text is not null and toxic in (0, 1)")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "grams": [grams(t).tobytes() for t in batch["text"]]})

    found = sample.mapInPandas(features, "toxic int, grams binary").toArrow()
    labels = found["toxic"].to_numpy()
    toxic, rows = int(labels.sum()), len(labels)
    if toxic in (0, rows):
        smoothed = (toxic + 1) / (rows + 2)
        return ToxicityModel(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(smoothed / (1 - smoothed))))
    return _fitted([np.frombuffer(g.as_buffer(), np.int32) for g in found["grams"]], labels, toxic / rows if share is None else share)


def _fitted(texts: list[np.ndarray], toxic: np.ndarray, share: float) -> ToxicityModel:
    """Logistic regression by Adam over all rows, in blocks of rows to bound memory."""
    buckets = 1 << BUCKET_BITS
    texts, toxic = [g for g in texts if len(g)], toxic[[len(g) > 0 for g in texts]]
    order = np.argsort([len(g) for g in texts], kind="stable")
    texts, toxic = [texts[i] for i in order], toxic[order]
    present = np.zeros((2, buckets))
    for grams_, y in zip(texts, toxic, strict=True):
        present[y, grams_] += 1
    number = np.maximum(np.bincount(toxic, minlength=2)[:2], 1)
    ratio = np.log((present[1] + 1) / (number[1] + 2)) - np.log((present[0] + 1) / (number[0] + 2))
    norms = np.array([np.sqrt((ratio[g] ** 2).sum() / len(g)) for g in texts])
    ratio = (ratio / max(np.sqrt((norms**2).mean()) if len(norms) else 0.0, 1e-9)).astype(np.float32)
    blocks = []
    for at in range(0, len(texts), ROWS):
        own, texts[at : at + ROWS] = texts[at : at + ROWS], [None] * len(texts[at : at + ROWS])
        sizes = np.array([len(g) for g in own])
        blocks.append((np.concatenate(own), np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes, (1 / np.sqrt(sizes)).astype(np.float32), toxic[at : at + ROWS]))
    weights, bias = np.zeros(buckets, np.float32), 0.0
    mean, spread, mean_b, spread_b = np.zeros(buckets, np.float32), np.zeros(buckets, np.float32), 0.0, 0.0
    for step in range(1, STEPS + 1):
        scaled, gradient, gradient_b = weights * ratio, np.zeros(buckets), 0.0
        for ids, starts, sizes, scale, y in blocks:
            error = (1 / (1 + np.exp(-(np.add.reduceat(scaled[ids], starts) * scale + bias))) - y) / len(texts)
            gradient += np.bincount(ids, weights=np.repeat(error * scale, sizes), minlength=buckets)
            gradient_b += float(error.sum())
        gradient = (gradient * ratio + PENALTY * weights).astype(np.float32)
        mean, spread = 0.9 * mean + 0.1 * gradient, 0.99 * spread + 0.01 * gradient**2
        mean_b, spread_b = 0.9 * mean_b + 0.1 * gradient_b, 0.99 * spread_b + 0.01 * gradient_b**2
        weights = weights - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6).astype(np.float32)
        bias -= RATE * (mean_b / (1 - 0.9**step)) / (np.sqrt(spread_b / (1 - 0.99**step)) + 1e-8)
    sampled = float(toxic.mean()) if len(toxic) else 0.5
    odds = lambda p: np.log(max(p, 1e-6) / max(1 - p, 1e-6))
    return ToxicityModel((weights * ratio).astype(np.float32), float(bias + odds(share) - odds(sampled)))


def score_text(text: str | None, weights: np.ndarray, intercept: float) -> float:
    found = grams(text)
    total = float(weights[found].sum(dtype=np.float64)) / np.sqrt(len(found)) if len(found) else 0.0
    return float(1 / (1 + np.exp(-np.clip(total + intercept, -700, 700))))


def scored(df: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row with ``score``, the probability of the toxic label, and ``predicted``.

    Null, empty and blank texts get the score of the intercept alone. Input columns
    named like the results are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        weights, intercept = shared.value
        return pd.Series([score_text(t, weights, intercept) for t in texts], dtype="float64")

    rows = computed_once(df.select("*", F.col(text).alias("_text")), _rate=rate("_text"))
    return with_columns(rows, score=F.col("_rate"), predicted=(F.col("_rate") >= threshold).cast("int")).drop("_text", "_rate")


def toxic_documents(spark, folder: str) -> DataFrame:
    """op5: the toxicity of every document, learnt from the labels outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~in_fold("doc_id", 3, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample, share = sampled(labels)
    model = train(docs.join(F.broadcast(sample), "doc_id"), share=share)  # some thousand rows, whatever the size of the tables
    return scored(docs, model).select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")
