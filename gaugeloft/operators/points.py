"""Point data: chunks, single points and long measurements."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloft.functions.naming import file_id, point_id
from gaugeloft.operators.latest import latest
from gaugeloft.operators.ranks import positions
from gaugeloft.session import settle
from gaugeloft.storage import ship_package

# Points per chunk, rows per export chunk, dimensions sent and exported.
CHUNK_POINTS = 10_000
EXPORT_CHUNK_POINTS = 100_000
CORE_DIMENSIONS = ["X", "Y", "Z", "intensity", "classification", "point_source_id"]
EXPORT_DIMENSIONS = [
    "X", "Y", "Z", "intensity", "return_number", "number_of_returns",
    "scan_direction_flag", "edge_of_flight_line", "classification",
    "synthetic", "key_point", "withheld", "scan_angle_rank",
    "user_data", "point_source_id", "gps_time", "wavepacket_index",
    "wavepacket_offset", "wavepacket_size", "return_point_wave_location",
    "x_t", "y_t", "z_t",
]


def core_points(df: DataFrame, keep: list[str], dimensions: list[str] | None = None) -> DataFrame:
    """The core dimensions a file has; one it lacks is left out."""
    wanted = dimensions or CORE_DIMENSIONS
    return df.select(*keep, *[c for c in wanted if c in df.columns])


def chunk(
    points: DataFrame,
    files: list[str],
    position: str,
    size: int = CHUNK_POINTS,
    fields: list[str] | None = None,
) -> DataFrame:
    """One row per file and ``size`` consecutive points, chunks numbered from 0.

    A group never holds more than ``size`` points, however large its file is.
    """
    fields = fields or [c for c in points.columns if c not in files and c != position]
    numbered = points.withColumn("chunk_number", F.floor(F.col(position) / size).cast("int"))
    collected = numbered.groupBy(*files, "chunk_number").agg(
        F.sort_array(F.collect_list(F.struct(F.col(position).alias("_at"), *fields))).alias("points")
    )
    bare = F.transform("points", lambda p: F.struct(*[p[c].alias(c) for c in fields]))
    return collected.withColumn("points", bare)


def _folder(files: list[str], size: int):
    """Folds rows that come in order into pieces of chunks; a piece holds what one task has of its chunk."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows = None
        for batch in chain(batches, [None]):
            if batch is not None and open_rows is not None:
                batch = pa.Table.from_batches([open_rows, batch]).combine_chunks().to_batches()[0] if batch.num_rows else open_rows
            last = batch is None
            batch = open_rows if last else batch
            if batch is None or not batch.num_rows:
                continue
            position, file = batch.column("_position").to_numpy(), batch.column("_file").to_numpy()
            number = position // size
            cut = (np.diff(file) != 0) | (np.diff(number) != 0) | (np.diff(position) != 1)
            starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
            ends = np.append(starts[1:], batch.num_rows)
            if not last:
                open_rows = batch.slice(starts[-1])
                starts, ends = starts[:-1], ends[:-1]
            if len(starts):
                yield _pieces(batch, files, size, starts, ends, position, number)
            if last:
                break

    return fold


def _pieces(batch: pa.RecordBatch, files: list[str], size: int, starts: np.ndarray, ends: np.ndarray, position: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    whole = ends - starts == np.minimum(size, batch.column("_total").to_numpy()[starts] - number[starts] * size)
    offsets = pa.array(np.append(starts, ends[-1]).astype(np.int32))
    held = pa.ListArray.from_arrays(offsets, batch.column("_fields"))
    taken = [batch.column(f).take(pa.array(starts)) for f in files]
    return pa.RecordBatch.from_arrays([*taken, pa.array(number[starts].astype(np.int32)), pa.array(position[starts]), pa.array(whole), held], [*files, "chunk_number", "_first", "_whole", "points"])


def chunk_in_order(points: DataFrame, files: list[str], order: list[str], size: int = CHUNK_POINTS, fields: list[str] | None = None) -> DataFrame:
    """The same as ``chunk`` for points that have an order but no positions yet, with one shuffle of the points.

    The points are range-partitioned by file and order. A file's partitions are counted, which tells every task
    where its rows stand in their file, and it folds them into chunks as they come. Only chunks that an edge between
    tasks cuts are put together by a second shuffle, one or two for each task. A task holds a chunk and a batch.
    """
    fields = fields or [c for c in points.columns if c not in files]
    spark = points.sparkSession
    numbered = positions(points.select(*files, F.struct(*order).alias("_order"), F.struct(*fields).alias("_fields")), files, ["_order"])
    rows = numbered.select(*files, "_fields", F.col("position").alias("_position"), "_file", "_total")
    ship_package(spark)
    names = {f.name: f for f in rows.schema}
    out = T.StructType([*(names[f] for f in files), T.StructField("chunk_number", T.IntegerType()), T.StructField("_first", T.LongType()),
                        T.StructField("_whole", T.BooleanType()), T.StructField("points", T.ArrayType(names["_fields"].dataType))])
    pieces = settle(rows.mapInArrow(_folder(files, size), out))
    cut = pieces.filter("NOT _whole").groupBy(*files, "chunk_number").agg(F.sort_array(F.collect_list(F.struct("_first", "points"))).alias("_pieces"))
    return pieces.filter("_whole").select(*files, "chunk_number", "points").unionByName(cut.select(*files, "chunk_number", F.flatten("_pieces.points").alias("points")))


def unchunk(chunks: DataFrame, at: str = "point_position") -> DataFrame:
    """One row per point again, with its place in the chunk."""
    kept = [c for c in chunks.columns if c != "points"]
    return chunks.select(*kept, F.posexplode("points").alias(at, "point")).select(*kept, at, "point.*")


def file_totals(chunks: DataFrame, files: list[str] | None = None) -> DataFrame:
    """Points and chunks sent per file."""
    files = files or ["tenant_id", "file_name"]
    return chunks.groupBy(*files).agg(
        F.sum(F.size("points").cast("bigint")).alias("total_points"), F.count("*").alias("total_chunks")
    )


def in_chunks(points: DataFrame, position: str = "point_index", size: int = CHUNK_POINTS) -> DataFrame:
    """Chunk number and place in the chunk of single points, without building the chunks."""
    return points.withColumns(
        {
            "chunk_number": F.floor(F.col(position) / size).cast("int"),
            "point_position": (F.col(position) % size).cast("int"),
        }
    )


def stored_points(flat: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of the points table from unchunked or numbered points: stable ids, missing numbers as zero.

    ``keep`` names columns to carry along, such as the chunk that a table tells versions by.
    """
    if "file_id" not in flat.columns:
        flat = flat.withColumn("file_id", file_id(F.col("tenant_id"), F.col("file_name")))

    def number(name: str, kind: str):
        if name not in flat.columns:
            return F.lit(0).cast(kind)
        return F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind))

    return flat.select(
        "file_id",
        "tenant_id",
        "file_name",
        point_id(F.col("file_id"), F.col("chunk_number"), F.col("point_position")).alias("point_id"),
        number("X", "double").alias("x"),
        number("Y", "double").alias("y"),
        number("Z", "double").alias("z"),
        number("intensity", "double").alias("intensity"),
        number("classification", "int").alias("classification"),
        number("point_source_id", "int").alias("point_source_id"),
        number("scan_angle_rank", "int").alias("scan_angle_rank"),
        *(keep or []),
    )


def file_stats(completions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rows of the stats table from completion messages; other messages are left out.

    ``timestamp`` is when the file was ingested, by default now.
    """
    done = completions.filter(F.col("status") == "completed")
    return done.select(
        file_id(F.col("tenant_id"), F.col("file_name")).alias("file_id"),
        "tenant_id",
        "file_name",
        F.coalesce("file_size_mb", F.lit(0.0)).alias("file_size_mb"),
        F.coalesce("processing_time_sec", F.lit(0.0)).alias("ingestion_time_sec"),
        F.coalesce("total_points", F.lit(0).cast("bigint")).alias("records_processed"),
        "status",
        F.lit("[]").alias("errors"),
        (F.current_timestamp() if as_of is None else as_of).alias("timestamp"),
    )


def long_measurements(points: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each point as two rows: x and y, both at the depth of the point's z.

    Depth and value are 32-bit. ``keep`` names columns to carry along, such as the write order.
    """
    keep = keep or []
    single = points.select("lidar_id", F.col("z").cast("float").alias("depth"), *keep, F.col("x").cast("float"), F.col("y").cast("float"))
    return single.unpivot(["lidar_id", "depth", *keep], ["x", "y"], "measurement_type", "value")


def latest_measurements(points: DataFrame, order: list[str]) -> DataFrame:
    """The long rows that remain when later points overwrite earlier ones of the same depth.

    x and y of a point are written together, so points are reduced first and unpivoted after.
    """
    single = points.select("lidar_id", F.col("z").cast("float").alias("z"), F.col("x").cast("float"), F.col("y").cast("float"), *order)
    return long_measurements(latest(single, ["lidar_id", "z"], order))


def first_points(points: DataFrame, wanted: int | None, position: str, size: int = EXPORT_CHUNK_POINTS) -> DataFrame:
    """The leading points of a file, rounded up to whole chunks; none wanted means all."""
    if not wanted:
        return points
    return points.filter(F.col(position) < math.ceil(wanted / size) * size)


def export_columns(points: DataFrame) -> DataFrame:
    """The 23 exported dimensions in order, null where the file lacks one."""
    have = set(points.columns)
    return points.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in EXPORT_DIMENSIONS])
