"""Keyed tables where the last write of a key wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

WHOLE = (ByteType, ShortType, IntegerType, LongType)
FIXED_WIDTH = (*WHOLE, BooleanType, FloatType, DoubleType, DateType, TimestampType, TimestampNTZType)


def latest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row per key: the one with the highest version.

    Both forms combine rows before the shuffle, so a hot key sends one row per task. With a single
    whole-number version, unique per key, and fixed-width values Spark can aggregate by hash; the
    other form sorts, and settles equal versions by the largest values.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    values = [c for c in df.columns if c not in keys and c not in version]
    rest = [*version, *values]
    if len(version) == 1 and isinstance(kinds[version[0]], WHOLE) and all(isinstance(kinds[c], FIXED_WIDTH) for c in values):
        order = F.coalesce(F.col(version[0]).cast("bigint"), F.lit(-(2**63)).cast("bigint"))
        picked = df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in rest])
    else:
        picked = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last")).select(*keys, "_last.*")
    return picked.select(*df.columns)


def has_null_key(keys: list[str]) -> Column:
    """True for rows a keyed table cannot take."""
    return reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed table can take, and rows with a null in the key."""
    missing = has_null_key(keys)
    return df.filter(~missing), df.filter(missing)
