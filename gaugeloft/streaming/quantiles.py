"""Running percentiles of a stream, and outliers judged by them: one mergeable sketch per group and micro-batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle
from gaugeloft.sinks import keyed

#: Size of a sketch: with 400 the rank of an answer is off by less than about 0.7% of the values, however many there are.
SKETCH_SIZE = 400
RANK_ERROR = 0.007


def sketches(df: DataFrame, group: list[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """A KLL sketch per group, combined before the shuffle. Null and NaN are left out."""
    number = F.col(value).cast("double")
    return df.filter(number.isNotNull() & ~F.isnan(number)).groupBy(*group).agg(F.kll_sketch_agg_double(number, size).alias("sketch"))


def quantiles_of(stored: DataFrame, group: list[str], fractions: dict[str, float]) -> DataFrame:
    """Per group the number of values, ``n``, and a value near each wanted rank, from sketches of any parts of it."""
    merged = stored.groupBy(*group).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(f))).alias(name) for name, f in fractions.items()]
    return merged.select(*group, F.kll_sketch_get_n_double("sketch").alias("n"), *found)


def read_quantiles(spark: SparkSession, root: str, group: list[str], fractions: dict[str, float], before: int | None = None) -> DataFrame:
    """The percentiles of all batches so far, or of those before one; their rank is off by ``RANK_ERROR`` at most.

    A batch holds one sketch of a few kilobytes per group, whatever came in it.
    """
    stored = keyed.read_versions(spark, root)
    return quantiles_of(stored if before is None else stored.filter(F.col(keyed.VERSION) < before), group, fractions)


def run_outliers(
    readings: DataFrame,
    sketch_root: str,
    outlier_root: str,
    checkpoint: str,
    group: list[str],
    value: str,
    low: float = 0.01,
    high: float = 0.99,
    bounded: bool = False,
) -> StreamingQuery:
    """Keeps sketches of a stream and stores the rows outside the percentiles that the batches before had.

    The first batch has nothing to be judged by. A batch that runs again is judged by the same batches and replaces
    what it had written. Rows with a null in the group are set aside, as in all keyed tables.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, settle(batch)
        try:
            bounds = settle(read_quantiles(spark, sketch_root, group, {"_low": low, "_high": high}, before=number))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            bounds = None
        if bounds is not None:
            judged = join_small(rows, bounds.drop("n"), group)
            outside = judged.filter((F.col(value) < F.col("_low")) | (F.col(value) > F.col("_high")))
            keyed.write_version(outside.drop("_low", "_high"), outlier_root, number, group)
        keyed.write_version(sketches(rows, group, value), sketch_root, number, group)

    writer = readings.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer).start()
