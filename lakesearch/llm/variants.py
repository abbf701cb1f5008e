"""Spelling variants: words one edit apart, grouped under the far more frequent form.

Every word of the vocabulary generates its deletions and replacements (an insertion is the
other word's deletion) and probes them against blocked Bloom filters, one for each length,
which are broadcast. Only the edits that a filter knows are spelled out and shuffled to an
exact join with the vocabulary, which removes the filters' false positives.

Words hash position by position, so all edits of a batch of words are a few array
operations. A filter holds 32 bits a word in blocks of 64; filters are broadcast up to
``FILTER_BYTES`` at a time, and a larger vocabulary is probed in several passes, which are
parts of the hash space and lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import written
from .bloom import FILTER_BYTES, MASKS, filled, held, masks, mixed, part_of
from .common import table

LEAST_CHARS = 6
LEAST_COUNT = 5
TIMES = 5
DAMAGE = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed: letters of words after lower-casing A-Z.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)

LONGEST = 64  # words of this many characters or more share a filter
WORDS_PER_BLOCK = 2
CELLS = 1 << 16


def words(df: DataFrame, key: str | None, text: str, least_chars: int = LEAST_CHARS, damage: int = DAMAGE) -> DataFrame:
    """``word``: each occurrence of a maximal run of letters, A-Z lower-cased, of at least ``least_chars`` characters.

    With a ``key``, a run whose crc32 of ``key:run`` ``damage`` divides loses the character that this number
    points at, before its length counts. Null texts have no words; a null key is empty.
    """
    owner = F.lit("") if key is None else F.coalesce(F.col(key).cast("string"), F.lit(""))
    pattern = f"[A-Za-zÀ-ÿ]{{{least_chars},}}"
    runs = df.select(owner.alias("_owner"), F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("_run"))
    if key is None:
        return runs.select(F.translate("_run", UPPER, LOWER).alias("word"))
    runs = runs.select("_owner", F.translate("_run", UPPER, LOWER).alias("_run"))
    number = F.crc32(F.concat(F.col("_owner"), F.lit(":"), F.col("_run")))
    at = (number % F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    return runs.select(F.when(number % damage == 0, cut).otherwise(F.col("_run")).alias("word")).where(F.length("word") >= least_chars)


def vocabulary(occurrences: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the words that occur often enough."""
    return occurrences.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def cell_hashes(letters: np.ndarray, first: int = 0) -> np.ndarray:
    """The share of each (row, position) in the hash of a word; ``first`` is the position of column 0."""
    places = np.arange(first, first + letters.shape[1], dtype=np.uint64) << np.uint64(8)
    return mixed(places | letters.astype(np.uint64))


def by_length(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``index, letters`` for the words of each length: a matrix of single bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for size in np.unique(sizes):
        index = np.flatnonzero(sizes == size)
        joined = "".join([texts[i] for i in index]).encode("latin-1")
        yield index, np.frombuffer(joined, np.uint8).reshape(len(index), size)


def shard(size: int, part):
    """The number of a filter."""
    return part * (LONGEST + 1) + size


def layouts(counts: dict[int, int], limit: int = FILTER_BYTES) -> list[dict[int, tuple[int, int, list[int]]]]:
    """The passes: for each, by length, ``blocks`` and ``parts`` of the whole filter and the parts to probe."""
    passes: list[dict[int, tuple[int, int, list[int]]]] = []
    room = 0
    for size, n in sorted(counts.items()):
        parts = -(-n // (WORDS_PER_BLOCK * max(1, limit // 8)))
        blocks = max(1, -(-n // (WORDS_PER_BLOCK * parts)))
        for part in range(parts):
            if not passes or room < 8 * blocks:
                passes.append({})
                room = max(limit, 8 * blocks)
            passes[-1].setdefault(size, (blocks, parts, []))[2].append(part)
            room -= 8 * blocks
    return passes


def filters(vocab: DataFrame, layout: dict[int, tuple[int, int, list[int]]]) -> dict[int, np.ndarray]:
    """The filters of a pass, by ``shard``; at most ``FILTER_BYTES`` reach the driver."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, letters in by_length(batch["word"].tolist()):
                size = min(letters.shape[1], LONGEST)
                if size not in layout:
                    continue
                blocks, parts, wanted = layout[size]
                hashes = np.bitwise_xor.reduce(cell_hashes(letters), axis=1)
                part = part_of(hashes, parts)
                here = np.isin(part, np.array(wanted, np.uint64))
                yield masks(shard(size, part[here].astype(np.int64)), hashes[here], blocks)

    found = vocab.select("word").mapInPandas(keys, MASKS)
    return filled(found, {shard(size, p): blocks for size, (blocks, _, wanted) in layout.items() for p in wanted})


def edits(letters: np.ndarray, alphabet: np.ndarray, least_chars: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """``first row, first position, hashes, valid, length`` of generated edits, in arrays of bounded size.

    Hashes by (row, position) are deletions, by (row, position, letter of the alphabet) replacements.
    """
    n, size = letters.shape
    for top in range(0, n, max(1, CELLS // (size * 4))):
        rows = letters[top : top + max(1, CELLS // (size * 4))]
        cells = cell_hashes(rows)
        whole = np.bitwise_xor.reduce(cells, axis=1)
        if size > least_chars:
            before = np.zeros_like(cells)
            before[:, 1:] = np.bitwise_xor.accumulate(cells, axis=1)[:, :-1]
            moved = np.zeros_like(cells)
            moved[:, :-1] = cell_hashes(rows[:, 1:])
            after = np.bitwise_xor.accumulate(moved[:, ::-1], axis=1)[:, ::-1]
            fresh = np.ones(rows.shape, bool)
            fresh[:, 1:] = rows[:, 1:] != rows[:, :-1]  # of equal neighbours, the first goes
            yield top, 0, before ^ after, fresh, size - 1
        wide = max(1, CELLS // (len(alphabet) * size))
        for start in range(0, len(rows), wide):
            some = slice(start, start + wide)
            step = max(1, CELLS // (len(alphabet) * len(rows[some])))
            for at in range(0, size, step):
                places = slice(at, at + step)
                kept = whole[some, None] ^ cells[some, places]
                other = cell_hashes(np.repeat(alphabet[:, None], len(cells[0, places]), axis=1), at)
                yield top + start, at, kept[:, :, None] ^ other.T[None], rows[some, places, None] != alphabet, size


def candidates(vocab: DataFrame, layout: dict[int, tuple[int, int, list[int]]], known, alphabet: np.ndarray, least_chars: int) -> DataFrame:
    """``word, edit, shorter``: generated edits that the broadcast filters ``known`` may hold."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = known.value
        for batch in batches:
            texts = batch["word"].tolist()
            for index, letters in by_length(texts):
                for top, at, hashes, valid, size in edits(letters, alphabet, least_chars):
                    kind = min(size, LONGEST)
                    if kind not in layout:
                        continue
                    _, parts, wanted = layout[kind]
                    for p in wanted:
                        hit = valid & held(filters[shard(kind, p)], hashes)
                        if parts > 1:
                            hit &= part_of(hashes, parts) == np.uint64(p)
                        found = np.nonzero(hit)
                        owners = [texts[i] for i in index[found[0] + top]]
                        places = (found[1] + at).tolist()
                        new = [""] * len(owners) if hashes.ndim == 2 else list(alphabet[found[2]].tobytes().decode("latin-1"))
                        spelled = [w[:i] + c + w[i + 1 :] for w, i, c in zip(owners, places, new, strict=True)]
                        yield pd.DataFrame({"word": pd.Series(owners, dtype=object), "edit": pd.Series(spelled, dtype=object), "shorter": hashes.ndim == 2})

    return vocab.select("word").mapInPandas(probe, "word string, edit string, shorter boolean")


def near_words(vocab: DataFrame, least_chars: int, limit: int = FILTER_BYTES) -> DataFrame:
    """``word, near, near_n``: every pair of different words one edit apart, in both directions."""
    shard = F.least(F.length("word"), F.lit(LONGEST))
    counts = {r["size"]: r["n"] for r in vocab.groupBy(shard.alias("size")).agg(F.count("*").alias("n")).collect()}
    present = F.explode(F.array_distinct(F.split("word", "")))
    alphabet = np.array(sorted(ord(r[0]) for r in vocab.select(present.alias("letter")).where("letter != ''").distinct().collect()), np.uint8)
    spark, out = vocab.sparkSession, None
    for layout in layouts(counts, limit):
        known = spark.sparkContext.broadcast(filters(vocab, layout))
        found = candidates(vocab, layout, known, alphabet, least_chars).join(vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
        found = written(found.join(vocab, "word"), "near-words")
        known.unpersist()
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vocab.select("word", F.col("word").alias("near"), F.col("n").alias("near_n"))
    back = out.where("shorter").select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return out.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")).unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the last of the forms that follow each other.

    Forms grow in count by a factor, so a chain is short; it is halved in each round.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = written(state.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def grouped(vocab: DataFrame, least_chars: int = LEAST_CHARS, times: int = TIMES, limit: int = FILTER_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``word, n``, whose words are distinct, of ``LETTERS`` and not shorter than ``least_chars``.

    ``form`` is the most frequent word one edit away (ties: least in code-point order) if it is at least ``times`` as
    frequent, else null, and then ``root`` is the word itself. No row at all for an empty vocabulary.
    """
    vocab = written(vocab, "vocabulary")
    near = near_words(vocab, least_chars, limit)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    rows = vocab.join(best, "word", "left")
    takes = -F.col("_best.less") >= F.col("n") * times
    rows = rows.select("word", F.when(takes, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, -F.col("_best.less")).alias("form_n"))
    rows = written(rows, "forms")
    return rows.join(roots(rows.where("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(spark, folder: str) -> DataFrame:
    """op11: the words of all documents, each with the form that it is a variant of."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return grouped(vocabulary(words(docs, "doc_id", "text")))
