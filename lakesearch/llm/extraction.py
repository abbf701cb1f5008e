"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page is the sequence of its leaf blocks. Features are the open elements, the words of
their classes, ids and roles, and properties of the text; transitions depend on
whether two neighbours stand in the same element. The field is trained on labelled
pages by gradient ascent on the exact log-likelihood (forward-backward), and Viterbi
decoding tells main blocks from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import computed_once
from .common import table, with_columns
from .pages import Block, blocks_of, labelled_pages

STEPS = 120
RATE = 0.1
PENALTY = 2e-4
SMALL_WORDS = re.compile(r"[^\W\d_]+|©")


@dataclass(frozen=True)
class BlockField:
    """Weight of each feature for a main block against another, and of transitions by [moved][from][to]."""

    weights: dict[str, float]
    moves: np.ndarray


@lru_cache(maxsize=20_000)
def _place(tags: tuple[str, ...], names: frozenset[str]) -> tuple[str, ...]:
    """Features of where a block stands; many blocks share a place."""
    found = {f"in:{t}" for t in tags if t not in ("html", "body", "div", "p")}
    found.add(f"at:{tags[-1] if tags else ''}")
    found.add(f"on:{'/'.join(tags[-2:])}")
    return tuple(sorted(found | {f"name:{n}" for n in names}))


def features(block: Block) -> list[str]:
    text = block.text
    n = len(text)
    out = ["bias", *_place(block.tags, block.names)]
    words = text.count(" ") + 1
    out.append(f"words:{min(words.bit_length(), 8)}")
    share = block.linked / n
    out.append(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
    out.append(f"end:{'stop' if text[-1] in '.!?…。' else 'other'}")
    out.append(f"commas:{min(text.count(','), 3)}")
    if words <= 12:
        out += {f"word:{w.lower()}" for w in SMALL_WORDS.findall(text)}
    return out


def train(pages: list[list[Block]] | None = None) -> BlockField:
    """Fit the field on labelled pages (``Block.main``), by default the generated ones.

    Adam on the mean log-likelihood of a page minus an L2 penalty. A feature must occur
    in three blocks to be learnt.
    """
    pages = labelled_pages() if pages is None else pages
    counts: dict[str, int] = {}
    sequences = [[features(b) for b in page] for page in pages]
    for page in sequences:
        for block in page:
            for f in set(block):
                counts[f] = counts.get(f, 0) + 1
    known = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= 3))}
    most = max(map(len, pages))
    size = np.array([len(p) for p in pages])
    gold = np.zeros((len(pages), most), int)
    moved = np.zeros((len(pages), most), int)
    ids, owner = [], []
    for p, (page, found) in enumerate(zip(pages, sequences, strict=True)):
        for t, (block, own) in enumerate(zip(page, found, strict=True)):
            gold[p, t] = block.main
            moved[p, t] = t > 0 and _moved(page[t - 1], block)
            own = [known[f] for f in own if f in known]
            ids += own
            owner += [p * most + t] * len(own)
    ids, owner = np.array(ids), np.array(owner)
    inside = np.arange(most) < size[:, None]
    theta = np.zeros(len(known) + 8)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        moves = theta[len(known) :].reshape(2, 2, 2)
        score = np.zeros((len(pages), most, 2))
        score[:, :, 1] = np.bincount(owner, weights=theta[ids], minlength=len(pages) * most).reshape(len(pages), most)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, most):
            new = score[:, t] + np.logaddexp(forward[:, t - 1, 0, None] + moves[moved[:, t], 0], forward[:, t - 1, 1, None] + moves[moved[:, t], 1])
            forward[:, t] = np.where(inside[:, t, None], new, forward[:, t - 1])
        for t in range(most - 2, -1, -1):
            ahead = score[:, t + 1] + backward[:, t + 1]
            new = np.logaddexp(moves[moved[:, t + 1], :, 0] + ahead[:, None, 0], moves[moved[:, t + 1], :, 1] + ahead[:, None, 1])
            backward[:, t] = np.where(inside[:, t + 1, None], new, 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        belief = np.exp(np.where(inside, forward[:, :, 1] + backward[:, :, 1] - total[:, None], -np.inf))
        error = np.where(inside, gold - belief, 0).ravel()
        gradient = np.zeros_like(theta)
        gradient[: len(known)] = np.bincount(ids, weights=error[owner], minlength=len(known))
        for t in range(1, most):
            live = inside[:, t]
            pair = forward[:, t - 1, :, None] + moves[moved[:, t]] + (score[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
            pair = -np.exp(np.where(live[:, None, None], pair, -np.inf))
            pair[np.arange(len(pages)), gold[:, t - 1], gold[:, t]] += live
            np.add.at(gradient[len(known) :].reshape(2, 2, 2), moved[:, t], pair)
        gradient = gradient / len(pages) - PENALTY * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return BlockField({f: float(theta[i]) for f, i in known.items()}, theta[len(known) :].reshape(2, 2, 2).copy())


def _moved(before: Block, block: Block) -> bool:
    return before.tags[:-1] != block.tags[:-1] or before.names != block.names


def decoded(blocks: list[Block], weights: dict[str, float], moves: list) -> list[bool]:
    """Viterbi: the most likely labels of a page's blocks; ties count as not main."""
    back: list[tuple[bool, bool]] = []
    no = yes = 0.0
    for t, block in enumerate(blocks):
        score = 0.0
        for f in features(block):
            score += weights.get(f, 0.0)
        if t:
            move = moves[_moved(blocks[t - 1], block)]
            a, b, c, d = no + move[0][0], yes + move[1][0], no + move[0][1], yes + move[1][1]
            back.append((b > a, d > c))
            no, yes = max(a, b), max(c, d) + score
        else:
            no, yes = 0.0, score
    if not blocks:
        return []
    label = yes > no
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


def main_text(page: str | None, weights: dict[str, float], moves: list) -> str:
    blocks = blocks_of(page)
    return " ".join(b.text for b, main in zip(blocks, decoded(blocks, weights, moves), strict=True) if main)


def extracted(df: DataFrame, field: BlockField, page: str = "html", text: str = "text") -> DataFrame:
    """Every row with the main text of its page; empty for a null, empty or textless page.

    An input column named like the result is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast((field.weights, field.moves.tolist()))

    @F.pandas_udf("string")
    def taken(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, moves = shared.value
        for pages in batches:
            yield pd.Series([main_text(p, weights, moves) for p in pages], dtype=object)

    rows = computed_once(df.select("*", F.col(page).alias("_page")), _main=taken("_page"))
    return with_columns(rows, **{text: F.col("_main")}).drop("_page", "_main")


def page_texts(spark, folder: str) -> DataFrame:
    """op1: the main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extracted(pages, train()).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
