"""LAS point clouds: a batch source, a description, and files arriving on a stream."""

from __future__ import annotations

import json
import posixpath
import struct
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from gaugeloft.functions.measures import MEGABYTE
from gaugeloft.functions.naming import DEFAULT_TENANT
from gaugeloft.operators.points import CHUNK_POINTS, CORE_DIMENSIONS
from gaugeloft.session import qualified
from gaugeloft.sources import las_records
from gaugeloft.storage import filesystem_of, ship_package

# Fixed value: file names taken, upper or lower case.
GLOB = "*.[lL][aA][sS]"
SPLIT_BYTES = 128 * 1024 * 1024
OPEN_COST = 4 * 1024 * 1024
LABELS = ["tenant_id", "file_name"]
PLACES = [*LABELS, "point_index", "point_format_id"]
SAMPLE_POINTS = 5
MAX_TASKS = 100_000
HEADERS_PER_TASK = 64


def _arrow_field(name: str) -> pa.Field:
    if name in LABELS or name == "file_id":
        return pa.field(name, pa.string())
    return pa.field(name, pa.int64() if name == "point_index" else las_records.arrow_type(name))


def spark_schema(columns: list[str]) -> StructType:
    return from_arrow_schema(pa.schema([_arrow_field(c) for c in columns]))


def labels_of(path: str) -> dict[str, str]:
    """Tenant and file name of a path, as the column functions in ``naming`` give them."""
    parts = path.split("/")
    tenant = next((p for p in parts if p.startswith("tenant")), DEFAULT_TENANT)
    return {"tenant_id": tenant, "file_name": parts[-1]}


def _labels_with_id(path: str) -> dict[str, str]:
    """With the file id too, made once per file instead of once per point."""
    labels = labels_of(path)
    name = f"{labels['tenant_id']}:{labels['file_name']}"
    return {**labels, "file_id": str(uuid.uuid5(uuid.NAMESPACE_DNS, name))}


def _list_files(paths: list[str], recursive: bool) -> list[tuple[str, int]]:
    """LAS files and their sizes. Only the listing is read, no file is opened."""
    found = []
    for path in paths:
        system, local = filesystem_of(path)
        info = system.get_file_info(local)
        if info.type == fs.FileType.NotFound:
            raise las_records.LasError(f"no such path: {path}")
        inside = info.type == fs.FileType.Directory
        infos = system.get_file_info(fs.FileSelector(local, recursive=recursive)) if inside else [info]
        base = path.rstrip("/")
        found += [(base + i.path[len(local.rstrip("/")) :], i.size) for i in infos if i.is_file and i.extension.lower() == "las"]
    return sorted(found)


class ByteRanges(InputPartition):
    """What one task reads: a part of a large file, or several small files."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


def packed(ranges: list[tuple[str, int, int]], limit: int, cost: int) -> list[ByteRanges]:
    """Ranges put together until their bytes, and ``cost`` for opening each, reach the limit."""
    parts: list[ByteRanges] = []
    room = -1
    for item in ranges:
        size = item[2] - item[1] + cost
        if size > room:
            parts.append(ByteRanges([]))
            room = limit + cost
        parts[-1].ranges.append(item)
        room -= size
    return parts


class LasReader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str], recursive: bool, split_bytes: int):
        self.columns = schema.fieldNames()
        self.paths, self.recursive, self.split_bytes = paths, recursive, split_bytes
        self.wanted: dict[str, set] = {}
        self.before: int | None = None

    def partitions(self) -> list[ByteRanges]:
        ranges = []
        for path, size in _list_files(self.paths, self.recursive):
            labels = labels_of(path)
            if all(labels[c] in values for c, values in self.wanted.items()):
                starts = range(0, max(size, 1), self.split_bytes)
                ranges += [(path, s, min(s + self.split_bytes, max(size, 1))) for s in starts]
        return packed(ranges, self.split_bytes, min(OPEN_COST, self.split_bytes))

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        for path, start, end in partition.ranges:
            yield from las_records.read_range(path, start, end, self.columns, labels_of(path), self.before)


class PruningLasReader(LasReader):
    """Skips files that a filter on tenant or file name rules out, and stops at a bound on the position."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            column = item.attribute[0] if hasattr(item, "attribute") and len(item.attribute) == 1 else None
            if column == "point_index" and isinstance(item, (LessThan, LessThanOrEqual)):
                bound = item.value + isinstance(item, LessThanOrEqual)
                self.before = bound if self.before is None else min(self.before, bound)
            elif column in LABELS and isinstance(item, (EqualTo, In)):
                values = {item.value} if isinstance(item, EqualTo) else set(item.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield item


class LasSource(DataSource):
    """Options: ``path`` or ``paths`` (JSON list), ``columns`` (JSON list), ``splitBytes``,
    ``recursive``, ``pruneFiles``."""

    @classmethod
    def name(cls) -> str:
        return "las"

    def _paths(self) -> list[str]:
        return json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]

    def _is(self, option: str) -> bool:
        return self.options.get(option, "false").lower() == "true"

    def schema(self) -> StructType:
        if "columns" in self.options:
            return spark_schema(json.loads(self.options["columns"]))
        return spark_schema([*PLACES, *las_records.all_dimensions(), *las_records.SCALED])

    def reader(self, schema: StructType) -> LasReader:
        kind = PruningLasReader if self._is("pruneFiles") else LasReader
        return kind(schema, self._paths(), self._is("recursive"), int(self.options.get("splitBytes", SPLIT_BYTES)))


def read_las(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    split_bytes: int = SPLIT_BYTES,
    recursive: bool = False,
) -> DataFrame:
    """Points of LAS files, each file split by bytes over many tasks.

    There are the dimensions of all point formats, the scaled coordinates, the tenant and file name
    from the path, the position in the file and the point format. ``columns`` decodes only what is
    needed; a dimension that some file lacks is null there. No file is opened for the schema.
    """
    ship_package(spark)
    spark.dataSource.register(LasSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("las").options(
        paths=json.dumps([qualified(spark, p) for p in ([paths] if isinstance(paths, str) else paths)]),
        splitBytes=str(split_bytes),
        recursive=str(recursive),
        pruneFiles="true",
    )
    return (reader.option("columns", json.dumps(columns)) if columns else reader).load()


def describe_las(spark: SparkSession, path: str, sample: int = SAMPLE_POINTS) -> DataFrame:
    """Dimension names of a file, its point format, and the values of its leading points."""
    names = las_records.read_header(qualified(spark, path)).dimensions
    points = read_las(spark, path, [*PLACES, *names])
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("dimension"), F.col(c).cast("double").alias("value")) for i, c in enumerate(names)])
    return (
        points.filter(F.col("point_index") < sample)
        .select("file_name", "point_format_id", "point_index", F.explode(pairs).alias("_d"))
        .select("file_name", "point_format_id", "point_index", "_d.*")
    )


def watch_las(spark: SparkSession, dirs: list[str] | str, per_trigger: int | None = None) -> DataFrame:
    """Stream of LAS files, those present first and new ones as they arrive, each once per checkpoint.

    ``dirs`` is one directory or glob, or several that share a parent. Only names and sizes are read.
    """
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", GLOB)
    reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    path = dirs if isinstance(dirs, str) else _glob_of(dirs)
    return reader.load(path).select("path", "modificationTime", "length")


def _glob_of(dirs: list[str]) -> str:
    parents = {posixpath.dirname(d.rstrip("/")) for d in dirs}
    if len(parents) != 1:
        raise ValueError("directories watched together must share a parent")
    return f"{parents.pop()}/{{{','.join(posixpath.basename(d.rstrip('/')) for d in dirs)}}}"


def _spread(rows: DataFrame, per_task: int) -> DataFrame:
    """Gives each task its share of rows that are small themselves but stand for much work.

    The number of tasks must be stated: left to itself, Spark packs so few bytes into one task.
    A stream cannot count its rows, so there it is the number of shuffle partitions.
    """
    spark = rows.sparkSession
    ship_package(spark)
    if rows.isStreaming:
        return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionByRange(max(1, min(MAX_TASKS, -(-rows.count() // per_task))), *rows.columns)


def _splits(files: DataFrame, split_bytes: int) -> DataFrame:
    """One row per byte range of each file, one task per range."""
    last = F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / split_bytes)
    numbered = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("split"))
    return _spread(numbered.select("path", (F.col("split") * split_bytes).alias("start")), 1)


def _or_nothing(batches: Iterator[pa.RecordBatch], skip_bad: bool) -> Iterator[pa.RecordBatch]:
    """The batches of one file; of a file that is no good none, if bad files are to be skipped."""
    try:
        yield from batches
    except (las_records.LasError, struct.error):
        if not skip_bad:
            raise


def points_of(files: DataFrame, columns: list[str] | None = None, split_bytes: int = SPLIT_BYTES, skip_bad: bool = False) -> DataFrame:
    """Points of a table or stream of files with ``path`` and ``length``, split by bytes like the source.

    ``skip_bad`` leaves out files that are no LAS files, which ``file_totals_of`` names.
    """
    columns = columns or ["file_id", *PLACES, *CORE_DIMENSIONS]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path, start = row["path"], row["start"]
                yield from _or_nothing(las_records.read_range(path, start, start + split_bytes, columns, _labels_with_id(path)), skip_bad)

    return _splits(files, split_bytes).mapInArrow(decode, spark_schema(columns))


def chunks_of(
    files: DataFrame, size: int = CHUNK_POINTS, dimensions: list[str] | None = None, split_bytes: int = SPLIT_BYTES,
    skip_bad: bool = False, timed: bool = False,
) -> DataFrame:
    """Chunk rows of a table or stream of files: tenant, file, chunk number and an array of points.

    A task reads the chunks that begin in its byte range to their end, so points are not shuffled.
    ``timed`` adds when reading a chunk began and ended, in seconds since 1970. ``skip_bad`` leaves out
    files that are no LAS files.
    """
    dimensions = dimensions or CORE_DIMENSIONS
    point = spark_schema(dimensions).simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path, start = row["path"], row["start"]
                began = time.time()
                for chunk in _or_nothing(las_records.read_chunks(path, start, start + split_bytes, dimensions, labels_of(path), size), skip_bad):
                    ended = time.time()
                    yield chunk.append_column("began", pa.array([began])).append_column("ended", pa.array([ended])) if timed else chunk
                    began = ended

    schema = f"tenant_id string, file_name string, chunk_number int, points array<{point}>" + ", began double, ended double" * timed
    return _splits(files, split_bytes).mapInArrow(decode, schema)


def file_totals_of(files: DataFrame, size: int = CHUNK_POINTS) -> DataFrame:
    """Per file: tenant, name, MB, points, chunks, declared points and ``error``. Only headers are read.

    A file that is no LAS file has an error and no points; one that is cut off has an error and the points it holds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [labels_of(p) for p in batch["path"].to_pylist()]
            held, declared, errors = zip(*[las_records.points_or_error(p) for p in batch["path"].to_pylist()], strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array([row[c] for row in labels], pa.string()) for c in LABELS],
                    batch["length"],
                    pa.array(held, pa.int64()),
                    pa.array(declared, pa.int64()),
                    pa.array(errors, pa.string()),
                ],
                names=[*LABELS, "length", "total_points", "declared_points", "error"],
            )

    counted = _spread(files.select("path", "length"), HEADERS_PER_TASK).mapInArrow(
        count, "tenant_id string, file_name string, length bigint, total_points bigint, declared_points bigint, error string"
    )
    return counted.select(
        *LABELS,
        "total_points",
        F.ceil(F.col("total_points") / size).alias("total_chunks"),
        (F.col("length") / MEGABYTE).alias("file_size_mb"),
        "declared_points",
        "error",
    )


def list_las(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Table of the LAS files below a path with ``path``, ``modificationTime`` and ``length``."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).option("recursiveFileLookup", recursive)
    return reader.load(path).select("path", "modificationTime", "length")
