"""Reproducible shuffling into shards: a Feistel permutation over global row numbers.

Rows are numbered 0 .. n-1 in a fixed order. A balanced Feistel network permutes the smallest domain
of an even number of bits that holds n; a value that falls outside walks on along its cycle until it
is inside. The position alone gives shard and slot, and the inverse finds the row again, so neither
a table of positions nor a second shuffle is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gaugeloft.llm.common import fresh, put, workers
from gaugeloft.session import settle

ROUNDS = 6
PRIME = (1 << 31) - 1
PART_BITS = 33


def _key(seed: int, number: int) -> int:
    """A multiplier or summand below the prime, drawn from the seed."""
    x = (seed * 0x9E3779B97F4A7C15 + (number + 1) * 0xD1B54A32D192ED03) % (1 << 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) % (1 << 64)
    return 1 + (x ^ (x >> 31)) % (PRIME - 1)


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. count-1. Whole numbers below 2**62 only, so that SQL can follow it."""

    count: int
    seed: int = 0

    @property
    def half_bits(self) -> int:
        return max(1, (max(self.count - 1, 1).bit_length() + 1) // 2)

    @property
    def keys(self) -> list[tuple[int, int, int]]:
        return [tuple(_key(self.seed, 3 * k + j) for j in range(3)) for k in range(ROUNDS)]

    def _round(self, half: np.ndarray, keys: tuple[int, int, int]) -> np.ndarray:
        first, added, second = keys
        x = (half * first + added) % PRIME
        x ^= x >> 15
        return (x * second) % PRIME & ((1 << self.half_bits) - 1)

    def _once(self, values: np.ndarray, inverse: bool) -> np.ndarray:
        left, right = values >> self.half_bits, values & ((1 << self.half_bits) - 1)
        if inverse:
            for keys in reversed(self.keys):
                left, right = right ^ self._round(left, keys), left
        else:
            for keys in self.keys:
                left, right = right, left ^ self._round(right, keys)
        return (left << self.half_bits) | right

    def _walk(self, values: np.ndarray, inverse: bool) -> np.ndarray:
        out = self._once(np.asarray(values, dtype=np.int64), inverse)
        while (outside := out >= self.count).any():
            out[outside] = self._once(out[outside], inverse)
        return out

    def position(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, inverse=False)

    def number(self, positions: np.ndarray) -> np.ndarray:
        return self._walk(positions, inverse=True)


def number_rows(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Numbers all rows 0, 1, 2, … in the given order, nulls first; returns them and their count.

    Range partitions hold the order, so no task sees more than its range; rows alike in ``order`` are
    told apart by their place in the input, which also spreads a key that many rows share. The rows
    are written once, since the ranges come from a sample. Only one count per partition reaches the
    driver.
    """
    tie, slot, part = fresh("tie"), fresh("slot"), fresh("part")
    marked = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(*[F.col(c) for c in [*order, tie]]).sortWithinPartitions(*order, tie)
    placed = settle(ranged.drop(tie).withColumn(slot, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(slot, PART_BITS))
    offsets, total = [], 0
    for number, rows in sorted(map(tuple, placed.groupBy(part).agg(F.count("*")).collect())):
        offsets.append((number, total))
        total += rows
    before = fresh("before")
    starts = df.sparkSession.createDataFrame(offsets, f"{part} bigint, {before} bigint")
    within = F.col(slot) - F.shiftleft(F.col(part), PART_BITS)
    joined = placed.join(F.broadcast(starts), part)
    return put(joined, {name: F.col(before) + within}).drop(slot, part, before), total


def shard_rows(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Adds ``row_number``, ``shard`` and ``slot``; input columns of these names are replaced.

    The law is ``rows``: sizes of any two shards differ by one row at most, and the slots of a shard
    run from 0 without a gap. Equal rows are rows of their own. Nulls in ``order`` come first. An
    empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    numbered, count = number_rows(workers(df), order, "row_number")
    permutation = Permutation(count, seed)

    @F.pandas_udf(LongType())
    def position(numbers):
        import pandas as pd

        return pd.Series(permutation.position(numbers.to_numpy()))

    at = fresh("position")
    placed = numbered.withColumn(at, position("row_number"))
    return put(placed, {"shard": (F.col(at) % shards).cast("int"), "slot": F.expr(f"`{at}` div {shards}")}).drop(at)
