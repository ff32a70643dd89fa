"""Readings to window averages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeloft.functions.convert import TRACE_START, epoch_to_time, event_time_or_arrival, parse_json, shift_epoch, time_to_text, utc_time
from gaugeloft.functions.measures import ANOMALY_THRESHOLD, is_over
from gaugeloft.schemas import READINGS

# Window length and allowed lateness.
WINDOW = "3 minutes"
WATERMARK = "30 seconds"


def readings_from_messages(
    messages: DataFrame, schema: StructType = READINGS, offset: int = TRACE_START, by_arrival: bool = False
) -> DataFrame:
    """Parsed readings of a topic with their event time and row flag.

    With ``by_arrival`` a reading that carries no time takes that of its message.
    """
    if not by_arrival:
        return with_event_time(parse_json(messages, "value", schema), offset)
    sent = messages.withColumnRenamed("timestamp", "arrival_time")
    timed = with_event_time(parse_json(sent, "value", schema, keep=["arrival_time"]), offset)
    return timed.withColumn("event_time", event_time_or_arrival(F.col("event_time"), F.col("arrival_time"))).drop("arrival_time")


def with_event_time(readings: DataFrame, offset: int = TRACE_START, threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    shifted = shift_epoch(F.col("timestamp"), offset)
    return readings.withColumns(
        {
            "adjusted_timestamp": shifted,
            "event_time": epoch_to_time(shifted),
            "is_anomaly": is_over(F.col("max_cpu"), threshold),
        }
    )


def window_average(
    readings: DataFrame,
    keys: list[str] | None = None,
    time: str = "event_time",
    value: str = "max_cpu",
    window: str = WINDOW,
    watermark: str = WATERMARK,
    threshold: float = ANOMALY_THRESHOLD,
    drop_nan: bool = False,
    unique_readings: bool = False,
) -> DataFrame:
    """Average per key and tumbling window, flagged when above the threshold.

    Works on tables and streams; the watermark only matters on streams. Rows without a time are
    not in any window. ``unique_readings`` counts a repeated (key, time) once.
    """
    keys = keys or ["vm_id"]
    if readings.isStreaming:
        readings = readings.withWatermark(time, watermark)
    if unique_readings:
        once = readings.dropDuplicatesWithinWatermark if readings.isStreaming else readings.dropDuplicates
        readings = once([*keys, time])
    if drop_nan:
        readings = readings.filter(~F.isnan(value))
    averages = readings.groupBy(*keys, F.window(time, window)).agg(F.avg(value).alias("avg_max_cpu"))
    return averages.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "avg_max_cpu",
        is_over(F.col("avg_max_cpu"), threshold).alias("is_window_anomaly"),
    )


def within(readings: DataFrame, start: datetime, end: datetime, time: str = "event_time") -> DataFrame:
    """The readings that windows inside a range are made of.

    A filter on window bounds cannot reach the files, this one can. Windows crossing an end of the
    range lose rows here and must be left out after.
    """
    return readings.filter((F.col(time) >= utc_time(start)) & (F.col(time) < utc_time(end)))


def silver_text(silver: DataFrame) -> DataFrame:
    """Window bounds as text, the form silver rows have in messages."""
    return silver.withColumns({c: time_to_text(F.col(c)) for c in ("window_start", "window_end")})


def row_alerts(readings: DataFrame, time: str = "event_time", threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    """Single readings above the threshold; stateless, so alerts leave with the batch they came in."""
    flagged = readings.withColumn("is_anomaly", is_over(F.col("max_cpu"), threshold))
    return flagged.filter("is_anomaly").select("vm_id", F.col(time).alias("timestamp"), "max_cpu", "is_anomaly")


def alert_rate(
    readings: DataFrame,
    window: str,
    limit: float,
    time: str = "event_time",
    threshold: float = ANOMALY_THRESHOLD,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Share of alerting readings per window, with the windows over the limit marked critical."""
    if readings.isStreaming:
        readings = readings.withWatermark(time, watermark)
    alerting: Column = is_over(F.col("max_cpu"), threshold)
    counted = readings.groupBy(F.window(time, window)).agg(
        F.count("*").alias("readings"), F.count_if(alerting).alias("alerts")
    )
    rate = F.col("alerts") / F.col("readings")
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "readings",
        "alerts",
        rate.alias("alert_rate"),
        (rate > limit).alias("is_critical"),
    )
