"""Data-quality checks: schema, ranges, completeness, outliers, drift, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gaugeloft.operators.joins import join_small
from gaugeloft.operators.ranks import exact_percentiles
from gaugeloft.session import settle

# Fixed value: share of nulls in a critical field that stops a batch.
DRIFT_LIMIT = 0.1


class SchemaDrift(ValueError):
    """A critical field is empty too often, so the producer has probably changed its schema."""


def null_ratios(df: DataFrame, fields: list[str], limit: float = DRIFT_LIMIT) -> DataFrame:
    """One row per critical field: share of nulls, and whether it exceeds the limit."""
    counted = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in fields])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_{c}").alias("nulls")) for c in fields])
    ratio = F.coalesce(F.try_divide(F.col("nulls"), F.col("rows")), F.lit(0.0))
    return (
        counted.select("rows", F.explode(pairs).alias("pair"))
        .select("pair.field", "rows", "pair.nulls")
        .withColumns({"null_ratio": ratio, "has_drifted": ratio > limit})
    )


def stop_on_drift(df: DataFrame, fields: list[str], limit: float = DRIFT_LIMIT) -> None:
    """Raises when a critical field exceeds the limit; an empty batch passes."""
    drifted = null_ratios(df, fields, limit).filter("has_drifted").collect()
    if drifted:
        raise SchemaDrift(", ".join(f"{r.field}: {r.nulls} of {r.rows} null" for r in drifted))


def validate_messages(df: DataFrame, column: str, schema: StructType, required: list[str] | None = None) -> DataFrame:
    """Parsed fields plus ``_errors``, which names each required field that is missing or of the wrong type."""
    required = required or schema.fieldNames()
    as_text = StructType([StructField(f.name, StringType(), True) for f in schema])
    text = F.col(column).cast("string")
    read = df.select("*", F.from_json(text, schema).alias("_typed"), F.from_json(text, as_text).alias("_text"))

    def problem(name: str) -> Column:
        return F.when(F.col(f"_text.{name}").isNull(), f"missing {name}").when(
            F.col(f"_typed.{name}").isNull(), f"wrong type {name}"
        )

    errors = F.array_compact(F.array(*[problem(c) for c in required]))
    kept = [c for c in df.columns if c != column]
    return read.select(*kept, "_typed.*", errors.alias("_errors"))


def range_errors(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Adds ``_out_of_range``: the columns whose value lies outside its bounds. Null is not outside."""

    def outside(name: str) -> Column:
        low, high = bounds[name]
        beyond = F.lit(False)
        if low is not None:
            beyond = beyond | (F.col(name) < low)
        if high is not None:
            beyond = beyond | (F.col(name) > high)
        return F.when(beyond, name)

    return df.withColumn("_out_of_range", F.array_compact(F.array(*[outside(c) for c in bounds])))


def split_by(df: DataFrame, errors: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with entries in an error column."""
    clean = F.size(errors) == 0
    return df.filter(clean), df.filter(~clean)


def completeness(df: DataFrame, required: list[str]) -> DataFrame:
    """Adds ``_missing``: the required columns that are null in the row, or that the data lacks."""
    flags = [F.when(F.col(c).isNull(), c) if c in df.columns else F.lit(c) for c in required]
    return df.withColumn("_missing", F.array_compact(F.array(*flags)))


def completeness_by(df: DataFrame, group: list[str], required: list[str]) -> DataFrame:
    """Per file or other group: rows, complete rows, and whether all rows are complete."""
    whole = F.size("_missing") == 0
    return completeness(df, required).groupBy(*group).agg(
        F.count("*").alias("rows"), F.count_if(whole).alias("complete_rows"), F.bool_and(whole).alias("is_complete")
    )


def outliers_by_deviation(df: DataFrame, group: list[str], value: str, times: float = 3.0) -> DataFrame:
    """Flags values further than ``times`` standard deviations from the mean of their group.

    Group statistics are joined back rather than computed over a window, so that a large group
    stays spread over many tasks.
    """
    stats = settle(df.groupBy(*group).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd")))
    far = F.abs(F.col(value) - F.col("_mean")) > times * F.col("_sd")
    return join_small(df, stats, group, "left").withColumn("is_outlier", F.coalesce(far, F.lit(False))).drop("_mean", "_sd")


def outliers_by_percentile(df: DataFrame, group: list[str], value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Flags values below the low or above the high percentile of their group."""
    stats = settle(exact_percentiles(df, group, value, {"_low": low, "_high": high}))
    out = (F.col(value) < F.col("_low")) | (F.col(value) > F.col("_high"))
    return join_small(df, stats, group, "left").withColumn("is_outlier", F.coalesce(out, F.lit(False))).drop("_low", "_high")


def quality_alerts(df: DataFrame, group: list[str], flags: dict[str, Column], limits: dict[str, float]) -> DataFrame:
    """Per group: the rate of each flag, and the names of the flags whose rate exceeds its limit."""
    rates = df.groupBy(*group).agg(
        F.count("*").alias("rows"), *[F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias(f"{n}_rate") for n, c in flags.items()]
    )
    raised = F.array(*[F.when(F.col(f"{n}_rate") > limit, n) for n, limit in limits.items()])
    return rates.withColumn("alerts", F.array_compact(raised))
