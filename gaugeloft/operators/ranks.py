"""Positions and percentiles within a group, without putting a group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

SLOT, PART, FIRST, OFFSET = "_slot", "_part", "_first", "_offset"
WEIGHT, SIZE, COUNT = "_weight", "_size", "_n"


def _placed(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows in (group, order) range partitions, each row with its place.

    A group larger than one partition continues in the next. The rows are settled because the
    range bounds come from a sample, which another run of the plan could draw differently.
    """
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    return settle(ranged.withColumn(SLOT, F.monotonically_increasing_id())).withColumn(PART, F.shiftright(SLOT, 33))


def _shares(placed: DataFrame, group: list[str], weight: Column) -> DataFrame:
    """Per group and partition it touches: its weight there, before it, and in all partitions.

    The windows run over one row per partition, not over the rows of the group.
    """
    per_part = placed.groupBy(*group, PART).agg(weight.alias(WEIGHT), F.min(SLOT).alias(FIRST))
    whole = W.partitionBy(*group)
    earlier = whole.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(WEIGHT).over(earlier), F.lit(0).cast("bigint"))
    return per_part.withColumns({OFFSET: before, SIZE: F.sum(WEIGHT).over(whole)})


def dense_position(df: DataFrame, group: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Numbers the rows of each group 0, 1, 2, … in the given order."""
    placed = _placed(df, group, order)
    shares = settle(_shares(placed, group, F.count("*")).drop(WEIGHT, SIZE))
    joined = join_small(placed, shares, [*group, PART])
    return joined.withColumn(name, F.col(OFFSET) + F.col(SLOT) - F.col(FIRST)).drop(SLOT, PART, FIRST, OFFSET)


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows in order within tasks, with their ``position`` in their group, ``_total`` of the group, and ``_file``, a number that
    the rows of a group in one range partition share and no others have."""
    placed = _placed(df, group, order)
    shares = settle(_shares(placed, group, F.count("*")).drop(WEIGHT))
    joined = join_small(placed, shares, [*group, PART])
    return joined.withColumns({"position": F.col(OFFSET) + F.col(SLOT) - F.col(FIRST), "_total": F.col(SIZE), "_file": F.col(FIRST)}).drop(SLOT, PART, FIRST, OFFSET, SIZE)


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` from the first row of each group up to this one, in an order without ties."""
    placed = _placed(df, group, order)
    shares = settle(_shares(placed, group, F.sum(value)).drop(WEIGHT, SIZE, FIRST))
    inside = W.partitionBy(PART, *group).orderBy(SLOT).rowsBetween(W.unboundedPreceding, 0)
    joined = join_small(placed, shares, [*group, PART]).withColumn(name, F.col(OFFSET) + F.sum(value).over(inside))
    return joined.drop(SLOT, PART, OFFSET)


def exact_percentiles(df: DataFrame, group: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """Interpolated percentiles per group, one column per entry of ``fractions``.

    Equal values are counted before the shuffle and put in order across partitions. The totals per
    partition tell which partitions hold the wanted ranks, and only those are looked at again.
    NaN and null are left out.
    """
    clean = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    placed = _placed(clean.groupBy(*group, value).agg(F.count("*").alias(COUNT)), group, [value])
    shares = _shares(placed, group, F.sum(COUNT))

    def ranks(fraction: float) -> tuple[Column, Column, Column]:
        wanted = (F.col(SIZE) - 1) * F.lit(float(fraction))
        return wanted, F.floor(wanted), F.ceil(wanted)

    ends = [rank for fraction in fractions.values() for rank in ranks(fraction)[1:]]
    holds = reduce(lambda a, b: a | b, [(F.col(OFFSET) <= r) & (r < F.col(OFFSET) + F.col(WEIGHT)) for r in ends])
    near = join_small(placed, settle(shares.filter(holds).drop(WEIGHT, FIRST)), [*group, PART])
    earlier = W.partitionBy(PART, *group).orderBy(SLOT).rowsBetween(W.unboundedPreceding, -1)
    before = F.col(OFFSET) + F.coalesce(F.sum(COUNT).over(earlier), F.lit(0).cast("bigint"))
    ranked = near.withColumn("_before", before)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col(COUNT)), F.col(value)))

    picks, columns = [], []
    for name, fraction in fractions.items():
        wanted, low, high = ranks(fraction)
        picks += [at(low).alias(f"_{name}_lo"), at(high).alias(f"_{name}_hi")]
        low_value, high_value = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        columns.append((low_value + (wanted - low) * (high_value - low_value)).alias(name))
    return ranked.groupBy(*group, SIZE).agg(*picks).select(*group, *columns)
