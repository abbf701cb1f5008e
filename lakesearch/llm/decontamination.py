"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of e edits is split into e + 1 pieces. A passage
within the budget holds at least one piece unchanged, so one automaton finds the exact
pieces of all items in a single pass over a text. The pieces are the leaves of a tree
whose nodes carry shares of the budget (left + right = parent - 1); a hit climbs it, each
node verified by Myers' bit-parallel distance against the text around the hit, and
most chance hits end after a few characters. An item is found when its root matches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..runtime import written
from .common import identity, small, table

BLOCK_BYTES = 4 * 1024 * 1024


def plain(text: str | None) -> str:
    """Lower case, white space runs as one space, no space at the ends."""
    return " ".join(text.lower().split()) if isinstance(text, str) else ""


@dataclass
class Node:
    """A stretch of an item with its share of the error budget."""

    text: str
    start: int
    budget: int
    parent: Node | None = None
    masks: dict[str, int] = field(default_factory=dict)

    def distance(self, window: str) -> tuple[int, int]:
        """Fewest edits that turn a substring of ``window`` into the node, and where it ends.

        Myers' bit-parallel search; ``budget`` + 1 if none is within the budget.
        """
        if not self.masks:
            for i, c in enumerate(self.text):
                self.masks[c] = self.masks.get(c, 0) | 1 << i
        size = len(self.text)
        full, last = (1 << size) - 1, size - 1
        up, down, score = full, 0, size
        best, ends = self.budget + 1, -1
        for at, c in enumerate(window, 1):
            same = self.masks.get(c, 0)
            zero = ((same & up) + up ^ up | same | down) & full
            rise, fall = down | full & ~(zero | up), zero & up
            score += (rise >> last & 1) - (fall >> last & 1)
            if score < best:
                best, ends = score, at
            rise, fall = rise << 1 & full, fall << 1 & full
            up, down = fall | full & ~(zero | rise), zero & rise
        return best, ends


def pieces(item: str, budget: int) -> list[Node]:
    """The ``budget`` + 1 leaves of an item's tree, sized in proportion to their share."""
    leaves: list[Node] = []

    def split(node: Node) -> None:
        if not node.budget:
            leaves.append(node)
            return
        left = (node.budget - 1) // 2
        cut = len(node.text) * (left + 1) // (node.budget + 1)
        split(Node(node.text[:cut], node.start, left, node))
        split(Node(node.text[cut:], node.start + cut, node.budget - 1 - left, node))

    split(Node(item, 0, budget))
    return leaves


class Matcher:
    """Finds the items in texts."""

    def __init__(self, items: list[tuple[Any, str]], share: float):
        places: dict[str, list[tuple[Any, Node]]] = {}
        for name, text in items:
            for leaf in pieces(text, int(len(text) * share)):
                places.setdefault(leaf.text, []).append((name, leaf))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in places.items():
            self.automaton.add_word(piece, owners)
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def __call__(self, text: str | None) -> dict[Any, tuple[int, int]]:
        """For each item in the text the fewest edits, and where that passage ends in the plain text."""
        text = plain(text)
        found: dict[Any, tuple[int, int]] = {}
        if self.empty or not text:
            return found
        done: set[tuple] = set()
        for end, owners in self.automaton.iter(text):
            for name, leaf in owners:
                origin = end + 1 - len(leaf.text) - leaf.start
                if name in found and found[name][0] == 0:
                    continue
                node, edits, ends = leaf, 0, end + 1
                while node.parent is not None:
                    node = node.parent
                    if (id(node), origin) in done:
                        break
                    done.add((id(node), origin))
                    first = max(0, origin + node.start - node.budget)
                    edits, ends = node.distance(text[first : origin + node.start + len(node.text) + node.budget])
                    if edits > node.budget:
                        break
                    ends += first
                else:
                    if name not in found or (edits, ends) < found[name]:
                        found[name] = edits, ends
        return found


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    share: float = 0.1,
    least_chars: int = 20,
) -> DataFrame:
    """``_doc, key, item, edits, ends_at`` for every test item that a text of ``df`` contains.

    An item is contained if some substring of the plain text is within ``share`` of the
    item's length in edits; ``edits`` is the fewest, ``ends_at`` where the first such
    passage ends. Null and blank texts contain nothing; items under ``least_chars`` plain
    characters, always null and blank ones, are not searched for. An item too short for an
    edit must occur exactly, also inside a word. Equal items are each found.
    Items are broadcast in blocks of bounded expected size, one pass over ``df`` each.
    """
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    rows = df.select(identity(key, text).alias("_doc"), F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.col(text).isNotNull())
    kind = T.StructType(
        [T.StructField("_doc", T.BinaryType()), T.StructField(key, df.schema[key].dataType), T.StructField(item, benchmark.schema[item].dataType), T.StructField("edits", T.IntegerType()), T.StructField("ends_at", T.IntegerType())]
    )
    out = None
    for block in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64(item_text), F.lit(blocks)) == block).select(item, item_text).distinct().collect()
        items = [(r[0], p) for r in own if len(p := plain(r[1])) >= max(1, least_chars)]
        shared = df.sparkSession.sparkContext.broadcast(items)

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            match = Matcher(shared.value, share)
            for batch in batches:
                hits = [(doc, name, i, *where) for doc, name, t in zip(batch["_doc"], batch["_key"], batch["_text"], strict=True) for i, where in match(t).items()]
                yield pd.DataFrame(hits, columns=kind.names)

        found = rows.mapInPandas(search, kind)
        out = found if out is None else out.unionByName(found)
    return out


def contaminated_documents(spark, folder: str) -> DataFrame:
    """op2: the benchmark items that each document contains, however short they are."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, folder, "benchmark"), least_chars=1).drop("_doc")


def decontamination_stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain no benchmark item of 20 characters or more; shorter ones occur in clean text."""
    found = contaminated(docs, table(spark, folder, "benchmark"))
    leaks = written(found.select("_doc").distinct(), "leaks")
    kept = docs.withColumn("_doc", identity("doc_id", "text")).join(small(leaks), "_doc", "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
