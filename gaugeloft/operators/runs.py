"""Records about ingestion runs, and statistics over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloft.functions.measures import estimated_mb, run_status, throughput
from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

GOOD = ("success", "completed")
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Fixed value: MB/s below which a tenant's runs are slow.
MIN_THROUGHPUT = 1.0


def log_time(time: Column) -> Column:
    return F.date_format(time, LOG_TIME)


def ingestion_record(runs: DataFrame, time: Column) -> DataFrame:
    """Log rows of file runs with size, seconds and points sent."""
    return runs.select(
        log_time(time).alias("timestamp"),
        "tenant_id",
        "file_name",
        "file_size_mb",
        "ingestion_time_sec",
        throughput(F.col("file_size_mb"), F.col("ingestion_time_sec")).alias("throughput_mb_sec"),
        "records_processed",
        run_status(F.col("records_processed")).alias("status"),
        (F.col("errors") if "errors" in runs.columns else F.array().cast("array<string>")).alias("errors"),
    )


def completed_record(completions: DataFrame, time: Column) -> DataFrame:
    """Log rows of completion messages; other messages are left out."""
    return completions.filter(F.col("status") == "completed").select(
        log_time(time).alias("timestamp"),
        "tenant_id",
        "file_name",
        "file_size_mb",
        "total_points",
        "processing_time_sec",
        throughput(F.col("file_size_mb"), F.col("processing_time_sec")).alias("throughput_mb_sec"),
        F.lit("completed").alias("status"),
    )


def chunk_record(chunks: DataFrame, time: Column, seconds: Column) -> DataFrame:
    """Log rows of stored chunks. The size is estimated from the number of points."""
    points = F.size("points").cast("bigint")
    return chunks.select(
        log_time(time).alias("timestamp"),
        "tenant_id",
        "file_name",
        "chunk_number",
        points.alias("points_processed"),
        seconds.alias("processing_time_sec"),
        throughput(estimated_mb(points), seconds).alias("throughput_mb_sec"),
        F.lit("success").alias("status"),
    )


def ingest_counters(lines: DataFrame, group: list[str]) -> DataFrame:
    """Lines, valid, invalid, sampled-out and sent lines, from lines marked ``is_valid`` and ``is_sampled``."""
    valid, sampled = F.col("is_valid"), F.col("is_sampled")
    return lines.groupBy(*group).agg(
        F.count("*").alias("lines"),
        F.count_if(valid & sampled).alias("valid"),
        F.count_if(~valid).alias("invalid"),
        F.count_if(valid & ~sampled).alias("filtered"),
        F.count_if(valid & sampled).alias("sent"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def _statistics() -> list[Column]:
    good = F.col("status").isin(*GOOD)
    return [
        F.count("*").alias("runs"),
        F.avg("throughput_mb_sec").alias("mean_throughput"),
        F.avg(F.when(good, F.col("throughput_mb_sec"))).alias("mean_good_throughput"),
        F.avg(F.coalesce(good, F.lit(False)).cast("double")).alias("success_rate"),
        F.avg("ingestion_time_sec").alias("mean_seconds"),
    ]


def run_statistics(logs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Runs, mean throughput, success rate and mean time per tenant."""
    return logs.groupBy(*(group or ["tenant_id"])).agg(*_statistics())


def run_trend(logs: DataFrame, time: Column, window: str, group: list[str] | None = None) -> DataFrame:
    """The same statistics per tenant and period."""
    group = group or ["tenant_id"]
    return (
        logs.withColumn("_time", time)
        .groupBy(*group, F.window("_time", window).alias("_window"))
        .agg(*_statistics())
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )


#: What makes a word of a message a value, and how many different words a place may have before they are values.
VALUE = r"[0-9/\\@]|[^.=][.=][^.=]"
MOST_VALUES = 8


def failure_patterns(logs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Errors that differ only in their numbers, counted together; a null pattern counts runs without errors."""
    group = group or ["tenant_id"]
    each = logs.select(*group, F.explode_outer("errors").alias("error"))
    pattern = F.regexp_replace("error", "[0-9]+", "#")
    return each.groupBy(*group, pattern.alias("pattern")).agg(F.count("*").alias("occurrences"))


def failure_templates(logs: DataFrame, group: list[str] | None = None, most: int = MOST_VALUES) -> DataFrame:
    """Errors of one template counted together: ``group, template, occurrences, distinct_messages``.

    A message is cut at spaces. A word with a digit, a slash, a backslash, an ``@`` or a dot or equals sign inside is a
    value, such as a number, path, host or id, and becomes ``*``. Messages of as many words and the same first word then share
    a template as far as their other words agree: a place at which they have more than ``most`` different words holds
    values, too, and becomes ``*`` in all of them. Words are counted per place, combined before the
    shuffle, so that a template of very many messages is a few rows. A run without errors has a null template.
    """
    group = group or ["tenant_id"]
    masked = F.transform(F.split(F.trim("error"), "\\s+"), lambda w: F.when(w.rlike(VALUE), "*").otherwise(w))
    each = logs.select(*group, F.explode_outer("errors").alias("error")).withColumn("words", masked)
    known = each.groupBy(*group, "words").agg(F.count("*").alias("n"), F.count_distinct("error").alias("messages"))
    shape = ["_length", "_lead"]
    shaped = settle(known.withColumns({"_length": F.size("words"), "_lead": F.get("words", F.lit(0))}))
    words = shaped.filter("words IS NOT NULL").select(*shape, F.posexplode("words").alias("_place", "_word")).distinct()
    free = words.groupBy(*shape, "_place").agg(F.count("*").alias("_values")).filter(F.col("_values") > most)
    places = settle(free.groupBy(*shape).agg(F.collect_list("_place").alias("_free")))
    joined = join_small(shaped, places, shape, "left")
    template = F.array_join(F.transform("words", lambda w, i: F.when(F.array_contains(F.coalesce("_free", F.array().cast("array<int>")), i), "*").otherwise(w)), " ")
    return joined.groupBy(*group, template.alias("template")).agg(F.sum("n").alias("occurrences"), F.sum("messages").alias("distinct_messages"))


def throughput_grid(logs: DataFrame, rows: str, columns: str, values: list, places: int | None = None) -> DataFrame:
    """Mean throughput with one row per value of ``rows`` and one column per listed value of ``columns``.

    What is not listed, null included, is averaged in the column ``other``.
    """
    mean = F.avg("throughput_mb_sec")
    names = [str(v) for v in values]
    shown = F.when(F.col(columns).isin(values), F.col(columns).cast("string")).otherwise("other")
    return logs.withColumn(columns, shown).groupBy(rows).pivot(columns, [*names, "other"]).agg(F.round(mean, places) if places is not None else mean)


def run_alerts(
    statistics: DataFrame,
    min_throughput: float = MIN_THROUGHPUT,
    max_error_rate: float | None = None,
    max_seconds: float | None = None,
) -> DataFrame:
    """Statistics rows that break a limit, with the reasons."""
    reasons = [F.when(F.col("mean_throughput") < min_throughput, "throughput")]
    if max_error_rate is not None:
        reasons.append(F.when(1 - F.col("success_rate") > max_error_rate, "error rate"))
    if max_seconds is not None:
        reasons.append(F.when(F.col("mean_seconds") > max_seconds, "processing time"))
    return statistics.withColumn("reasons", F.array_compact(F.array(*reasons))).filter(F.size("reasons") > 0)
