"""Language identification by known words, backing off to shorter character n-grams.

A word that training has seen scores its smoothed log frequency in each language. An
unseen word scores the mean log frequency of its character 4-grams; if none of them
is known, of its 3-grams, then 2-grams, then single letters. A text's score in a
language is the sum over its words; the prediction is the best sum plus the log prior.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import computed_once
from .common import in_fold, most_frequent, table, with_columns

UNDETERMINED = "und"
GRAMS = (4, 3, 2, 1)
SMOOTHING = 0.5
FLUSH = 50_000
REMEMBERED = 150_000
WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies by language; ``words`` and ``grams`` give row numbers of ``scores``.

    Row 0 is all zeros and stands for what has no letter or nothing known.
    """

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 3000,
    max_languages: int = 256,
    max_words: int = 200_000,
    max_grams: int = 100_000,
) -> LanguageModel:
    """Word and n-gram frequencies from a bounded sample of the labelled rows.

    ``rows_per_language`` is the expected sample of each language, drawn by a hash of
    the text and used whole. Of labels beyond ``max_languages`` the rarest are not
    learnt. ``max_words`` and ``max_grams`` bound the model over all languages, so it
    may be broadcast; the rarest entries go, and their words back off. Null labels and
    texts teach nothing; without any labelled row the model knows no language.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    found = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    languages = sorted(r["lang"] for r in found)
    size = {r["lang"]: r["count"] for r in found}
    if not languages:
        return LanguageModel([], np.zeros(0), {}, {}, np.zeros((1, 0), np.float32))
    spark = labelled.sparkSession
    shares = spark.createDataFrame([(x, min(1.0, rows_per_language / size[x])) for x in languages], "lang string, share double")
    sample = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    words = sample.select("lang", "text").mapInPandas(_count_words, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()
    per_language = lambda most: max(1, most // len(languages))
    kept = most_frequent(words.where("n > 1"), ["lang"], "n", per_language(max_words)).collect()
    grams = words.mapInPandas(_count_grams, "lang string, length int, gram string, n long")
    grams = grams.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")).persist()
    kept_grams = most_frequent(grams, ["lang", "length"], "n", per_language(max_grams // len(GRAMS))).collect()
    totals = {(r["lang"], 0): (r["n"], r["kinds"]) for r in words.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    totals |= {(r["lang"], r["length"]): (r["n"], r["kinds"]) for r in grams.groupBy("lang", "length").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    words.unpersist()
    grams.unpersist()
    at = {x: i for i, x in enumerate(languages)}
    word_rows = {w: i for i, w in enumerate(sorted({r["word"] for r in kept}), 1)}
    gram_rows = {g: i for i, g in enumerate(sorted({r["gram"] for r in kept_grams}), len(word_rows) + 1)}
    counts = np.zeros((1 + len(word_rows) + len(gram_rows), len(languages)))
    for r in kept:
        counts[word_rows[r["word"]], at[r["lang"]]] = r["n"]
    for r in kept_grams:
        counts[gram_rows[r["gram"]], at[r["lang"]]] = r["n"]
    length = np.array([0] * (1 + len(word_rows)) + [len(g) for g in gram_rows])
    scores = np.zeros(counts.shape, np.float32)
    for n in (0, *GRAMS):
        own = np.flatnonzero((length == n) & (np.arange(len(length)) > 0))
        for x in languages:
            total, kinds = totals.get((x, n), (0, 0))
            scores[own, at[x]] = np.log((counts[own, at[x]] + SMOOTHING) / (total + SMOOTHING * (kinds + 1)))
    prior = np.log(np.array([size[x] for x in languages], float) / sum(size.values()))
    return LanguageModel(languages, prior, word_rows, gram_rows, scores)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """Every row with its language and the posterior probability of it.

    ``und`` with score 0 where the text is null or has no letter, or the model knows
    no language. Ties go to the smaller language code. Input columns named like the
    two results are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.words, model.grams, model.scores))

    @F.pandas_udf("prediction string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(LanguageModel(*shared.value))
        for texts in batches:
            yield scorer(texts)

    found = computed_once(df.select("*", F.col(text).alias("_text")), _guess=guess("_text"))
    return with_columns(found, **{prediction: F.col("_guess.prediction"), score: F.col("_guess.score")}).drop("_text", "_guess")


def _words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}

    def rows() -> pd.DataFrame:
        out = [(x, w, n) for x, own in counts.items() for w, n in own.items() if any(map(str.isalpha, w))]
        counts.clear()
        return pd.DataFrame(out, columns=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            counts.setdefault(lang, Counter()).update(_words(text))
            if sum(map(len, counts.values())) > FLUSH:
                yield rows()
    yield rows()


def _padded(word: str) -> str:
    return f"^{word}$"


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}

    def rows() -> pd.DataFrame:
        out = [(x, len(g), g, n) for x, own in counts.items() for g, n in own.items()]
        counts.clear()
        return pd.DataFrame(out, columns=["lang", "length", "gram", "n"])

    for batch in batches:
        for lang, word, n in zip(batch["lang"], batch["word"], batch["n"], strict=True):
            own, padded = counts.setdefault(lang, Counter()), _padded(word)
            for size in GRAMS:
                for i in range(len(padded) - size + 1):
                    own[padded[i : i + size]] += n
        if sum(map(len, counts.values())) > FLUSH:
            yield rows()
    yield rows()


class _Scorer:
    """Scores texts one by one; remembers unseen words' scores up to a bound, then starts anew."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.rows = dict(self.model.words)
        known = len(self.model.scores)
        self.scores = np.resize(self.model.scores, (known + REMEMBERED, self.model.scores.shape[1]))
        self.used = known

    def _learn(self, new: list[str]) -> None:
        """Give each unseen word a row of its own: the mean of its longest known n-grams."""
        if self.used + len(new) > len(self.scores):
            self.scores = np.resize(self.scores, (self.used + len(new), self.scores.shape[1]))
        gram = self.model.grams.get
        flat: list[int] = []
        starts: list[int] = []
        row = self.used
        for word in new:
            if not word.isalpha() and not any(map(str.isalpha, word)):
                self.rows[word] = 0
                continue
            starts.append(len(flat))
            padded = _padded(word)
            for size in GRAMS:
                known = [g for i in range(len(padded) - size + 1) if (g := gram(padded[i : i + size])) is not None]
                if known:
                    break
            flat += known or [0]
            self.rows[word] = row
            row += 1
        if starts:
            sums = np.add.reduceat(self.model.scores[flat], starts)
            lengths = np.diff([*starts, len(flat)])[:, None]
            self.scores[self.used : row] = sums / lengths
            self.used = row

    def __call__(self, texts: pd.Series) -> pd.DataFrame:
        names = [UNDETERMINED] * len(texts)
        sure = np.zeros(len(texts))
        if self.model.languages:
            for i, text in enumerate(texts):
                words = _words(text) if isinstance(text, str) else []
                new = set(words).difference(self.rows)
                if self.used + len(new) > len(self.scores):
                    self._forget()
                    new = set(words).difference(self.rows)
                self._learn(sorted(new))
                rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
                if not rows.any():
                    continue
                total = self.scores[rows].sum(axis=0, dtype=np.float64) + self.model.prior
                best = int(total.argmax())
                names[i] = self.model.languages[best]
                sure[i] = 1.0 / np.exp(total - total[best]).sum()
        return pd.DataFrame({"prediction": names, "score": sure})


def predicted_languages(spark, folder: str) -> DataFrame:
    """op10: language of every document, learnt from the documents outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~in_fold("doc_id", 4, 2)))
    scored = identify(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def language_stage(spark, docs: DataFrame, folder: str, least: float = 0.5) -> DataFrame:
    """Documents whose language the model can tell: neither ``und`` nor a posterior below ``least``."""
    model = train(docs.where(~in_fold("doc_id", 4, 2)))
    names = docs.columns
    scored = identify(docs, model, prediction="_lang_pred", score="_lang_score")
    return scored.where((F.col("_lang_pred") != UNDETERMINED) & (F.col("_lang_score") >= least)).select(*[F.col(f"`{c}`") for c in names])
