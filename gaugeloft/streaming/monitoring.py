"""Measurements of running streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "batch_quality"
METRICS_SCHEMA = (
    "query_name string, batch_id bigint, batch_time string, input_rows bigint, rows_per_second double, "
    "latency_ms bigint, observed_rows bigint, error_rows bigint, error_percent double, backlog bigint, "
    "watermark_delay_sec double, late_rows bigint, state_rows bigint"
)


def observed(df: DataFrame, is_error: Column) -> DataFrame:
    """Counts rows and faulty rows of each batch while they pass; no extra job."""
    return df.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.count_if(is_error).alias("errors"))


def _seconds_behind(progress) -> float | None:
    event_time = progress.eventTime or {}
    if "max" not in event_time or "watermark" not in event_time:
        return None
    newest, watermark = (datetime.fromisoformat(event_time[k].replace("Z", "+00:00")) for k in ("max", "watermark"))
    return (newest - watermark).total_seconds()


def _backlog(progress) -> int | None:
    lags = [s.metrics.get("maxOffsetsBehindLatest") for s in progress.sources if s.metrics]
    known = [int(v) for v in lags if v is not None]
    return max(known) if known else None


def batch_metrics(progress) -> tuple:
    """One row of :data:`METRICS_SCHEMA` from a progress report."""
    seen = (progress.observedMetrics or {}).get(OBSERVED)
    rows = seen["rows"] if seen else None
    errors = seen["errors"] if seen else None
    percent = 100.0 * errors / rows if rows else None
    return (
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.processedRowsPerSecond or 0.0),
        progress.durationMs.get("triggerExecution"),
        rows,
        errors,
        percent,
        _backlog(progress),
        _seconds_behind(progress),
        sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        sum(s.numRowsTotal for s in progress.stateOperators),
    )


class MetricsListener(StreamingQueryListener):
    """Appends one row per micro-batch to a JSON table; add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.last_batch: int | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = self.spark.createDataFrame([batch_metrics(event.progress)], METRICS_SCHEMA)
        row.coalesce(1).write.mode("append").json(self.path)
        self.last_batch = event.progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)
