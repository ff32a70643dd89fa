"""Run logs: JSON lines per tenant and stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeloft.schemas import RUN_LOGS


def read_run_logs(spark: SparkSession, path: str | list[str], stage: str = "ingestion", glob: str | None = None) -> DataFrame:
    """Log rows of one stage: ``ingestion``, ``consumer`` or ``completed``."""
    reader = spark.read.schema(RUN_LOGS[stage])
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)
