"""File sinks: exported points and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeloft.operators.points import EXPORT_CHUNK_POINTS, export_columns, first_points


def export_points_csv(points: DataFrame, path: str, wanted: int | None = None, size: int = EXPORT_CHUNK_POINTS) -> None:
    """All points, or about ``wanted`` leading ones per file, with the 23 named dimensions and a header; missing values are empty.

    The order is kept by file: parts are written in order of the position in the file.
    """
    leading = first_points(points, wanted, "point_index", size)
    ordered = leading.repartitionByRange("file_name", "point_index").sortWithinPartitions("file_name", "point_index")
    export_columns(ordered).write.mode("overwrite").option("header", True).csv(path)


def log_batch(df: DataFrame, path: str, number: int) -> None:
    """The log rows of one micro-batch; a replay replaces them."""
    df.write.mode("overwrite").partitionBy("tenant_id").json(f"{path}/batch_id={number}")


def append_run_log(df: DataFrame, path: str) -> None:
    """JSON lines in one folder per tenant."""
    df.write.mode("append").partitionBy("tenant_id").json(path)
