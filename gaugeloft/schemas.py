"""Schemas of readings, messages, tables and run logs."""

from __future__ import annotations

import json
import logging

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

log = logging.getLogger(__name__)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


READINGS = _struct(
    timestamp=LongType(),
    vm_id=StringType(),
    min_cpu=DoubleType(),
    max_cpu=DoubleType(),
    avg_cpu=DoubleType(),
)

# Window bounds travel as text in messages.
SILVER_MESSAGE = _struct(
    vm_id=StringType(),
    window_start=StringType(),
    window_end=StringType(),
    avg_max_cpu=DoubleType(),
    is_window_anomaly=BooleanType(),
)

ENVELOPE = _struct(
    key=BinaryType(),
    value=BinaryType(),
    topic=StringType(),
    partition=IntegerType(),
    offset=LongType(),
    timestamp=TimestampType(),
)

# Stored topics keep each batch in a folder of its own.
STORED_ENVELOPE = StructType([*ENVELOPE, StructField("batch_id", LongType(), True)])

POINT = _struct(
    X=DoubleType(),
    Y=DoubleType(),
    Z=DoubleType(),
    intensity=DoubleType(),
    classification=IntegerType(),
    point_source_id=IntegerType(),
    scan_angle_rank=IntegerType(),
)

CHUNK_MESSAGE = _struct(
    tenant_id=StringType(),
    file_name=StringType(),
    chunk_number=IntegerType(),
    points=ArrayType(POINT),
    timestamp=DoubleType(),
)

COMPLETION_MESSAGE = _struct(
    tenant_id=StringType(),
    file_name=StringType(),
    status=StringType(),
    total_points=LongType(),
    total_chunks=LongType(),
    file_size_mb=DoubleType(),
    processing_time_sec=DoubleType(),
)

INGESTION_LOG = _struct(
    timestamp=StringType(),
    tenant_id=StringType(),
    file_name=StringType(),
    file_size_mb=DoubleType(),
    ingestion_time_sec=DoubleType(),
    throughput_mb_sec=DoubleType(),
    records_processed=LongType(),
    status=StringType(),
    errors=ArrayType(StringType()),
)

CHUNK_LOG = _struct(
    timestamp=StringType(),
    tenant_id=StringType(),
    file_name=StringType(),
    chunk_number=IntegerType(),
    points_processed=LongType(),
    processing_time_sec=DoubleType(),
    throughput_mb_sec=DoubleType(),
    status=StringType(),
)

COMPLETED_LOG = _struct(
    timestamp=StringType(),
    tenant_id=StringType(),
    file_name=StringType(),
    file_size_mb=DoubleType(),
    total_points=LongType(),
    processing_time_sec=DoubleType(),
    throughput_mb_sec=DoubleType(),
    status=StringType(),
)

RUN_LOGS = {"ingestion": INGESTION_LOG, "consumer": CHUNK_LOG, "completed": COMPLETED_LOG}


def parse_schema(text: str) -> StructType:
    """Schema from JSON text with a ``fields`` list; ``nullable`` defaults to true."""
    fields = [{"nullable": True, "metadata": {}, **f} for f in json.loads(text)["fields"]]
    return StructType.fromJson({"type": "struct", "fields": fields})


def load_schema(path: str, fallback: StructType = READINGS) -> StructType:
    """Schema from a JSON file; any failure is logged and gives the fallback."""
    try:
        with open(path, encoding="utf-8") as handle:
            return parse_schema(handle.read())
    except Exception:
        log.exception("schema %s could not be loaded, using the built-in one", path)
        return fallback
