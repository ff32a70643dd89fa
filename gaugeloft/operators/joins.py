"""Joins against tables that are usually, but not provably, small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 32 * 1024 * 1024
MAX_BROADCAST_ROWS = 500_000


def fits_broadcast(df: DataFrame) -> bool:
    """Measures the table: rows, and bytes of its rows as text."""
    size = df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES


def join_small(df: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Adds the columns of ``side``, matching null keys with null keys.

    The side is broadcast when its measured size allows it. Beyond that it is a shuffled join,
    whose hot keys are split at run time.
    """
    if not keys:
        return join_small(df.withColumn("_all", F.lit(0)), side.withColumn("_all", F.lit(0)), ["_all"], how).drop("_all")
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_side_{k}")) for k in keys])
    if fits_broadcast(side):
        renamed = F.broadcast(renamed)
    return df.join(renamed, matches, how).drop(*[f"_side_{k}" for k in keys])
