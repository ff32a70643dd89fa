"""LAS files made from a table, so that the LAS source has something to read."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.sources.las_records import RECORDS
from gaugeloft.storage import filesystem_of, ship_package

FILE_POINTS = 100_000


def las_bytes(point_format: int, columns: dict[str, np.ndarray], scale=(0.5, 0.5, 0.5), offset=(100.0, 200.0, 300.0)) -> bytes:
    """A LAS 1.2 file. Fields that are not given are zero."""
    count = len(columns["X"])
    records = np.zeros(count, dtype=np.dtype(RECORDS[point_format]))
    for name, values in columns.items():
        records[name] = values
    header = bytearray(227)
    header[0:4] = b"LASF"
    header[24:26] = bytes([1, 2])
    struct.pack_into("<HIIBHI", header, 94, 227, 227, 0, point_format, records.dtype.itemsize, count)
    struct.pack_into("<dddddd", header, 131, *scale, *offset)
    return bytes(header) + records.tobytes()


def stage_las(points: DataFrame, root: str) -> DataFrame:
    """Writes points as LAS files of at most 100,000 points in one directory per tenant.

    ``points`` has ``flag, point_index, X, Y, Z, intensity, classification, point_source_id,
    gps_time``. Returns one row per file written.
    """
    fields = ["X", "Y", "Z", "intensity", "point_source_id", "gps_time"]

    def write(group: pa.Table) -> pa.Table:
        group = group.sort_by("point_index")
        flag, part = group["flag"][0].as_py(), group["part"][0].as_py()
        columns = {name: group[name].to_numpy() for name in fields}
        columns["_class"] = group["classification"].to_numpy()
        system, folder = filesystem_of(f"{root}/tenant{flag}")
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{flag}_{part}.las") as out:
            out.write(las_bytes(1, columns))
        return pa.table({"file_name": [f"{flag}_{part}.las"], "points": [group.num_rows]})

    ship_package(points.sparkSession)
    parted = points.withColumn("part", F.floor(F.col("point_index") / FILE_POINTS))
    return parted.groupBy("flag", "part").applyInArrow(write, "file_name string, points bigint")
