"""Blocked Bloom filters: built on the executors by slices, of bounded size, probed by array operations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

PROBES = 4
FILTER_BYTES = 64 << 20
SLICE = 1 << 16  # blocks that one task fills


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number."""
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which part of the hash space a hash belongs to."""
    return (hashes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(parts)


# Fixed by PROBES: two bits of a block for each number below 4096.
_PAIRS = np.array([1 << (i & 63) | 1 << (i >> 6) for i in range(4096)], np.uint64)


def placed(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """``block, mask`` of hashes in a filter of ``blocks`` blocks of 64 bits; a mask has ``PROBES`` bits."""
    block = (hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    return block, _PAIRS[hashes & np.uint64(4095)] | _PAIRS[hashes >> np.uint64(12) & np.uint64(4095)]


def held(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each hash; never false for one that it was given."""
    block, mask = placed(hashes, len(cells))
    return (cells[block] & mask) == mask


def masks(shard: int | np.ndarray, hashes: np.ndarray, blocks: int) -> pd.DataFrame:
    """``shard, slice, block, mask`` that put hashes into the filter ``shard``."""
    block, mask = placed(hashes, blocks)
    return pd.DataFrame({"shard": shard, "slice": (block // np.uint64(SLICE)).astype(np.int32), "block": block.astype(np.int64), "mask": mask.view(np.int64)})


MASKS = "shard long, slice int, block long, mask long"


def filled(rows: DataFrame, blocks: dict[int, int]) -> dict[int, np.ndarray]:
    """The filter of each shard of ``blocks``, from the rows of ``masks``; their sum is what reaches the driver."""

    def fill(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        shard, at = map(int, key)
        cells = np.zeros(min(SLICE, blocks[shard] - at * SLICE), np.int64)
        np.bitwise_or.at(cells, some["block"].to_numpy() - at * SLICE, some["mask"].to_numpy())
        return pd.DataFrame({"shard": [shard], "slice": [at], "cells": [cells.tobytes()]})

    slices = rows.groupBy("shard", "slice").applyInPandas(fill, "shard long, slice int, cells binary")
    out = {shard: np.zeros(n, np.uint64) for shard, n in blocks.items()}
    for row in slices.toLocalIterator():
        cells = np.frombuffer(row["cells"], np.uint64)
        out[row["shard"]][row["slice"] * SLICE : row["slice"] * SLICE + len(cells)] = cells
    return out
