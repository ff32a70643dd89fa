"""Keyed tables as versions on storage.

Every write is one version in its own folder, and writing the same version again replaces it, so a
replayed batch leaves nothing behind twice. Readers take the last version of each key. A table of many
versions is rewritten to a new folder from time to time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from gaugeloft.functions.naming import file_id
from gaugeloft.operators.joins import fits_broadcast
from gaugeloft.operators.latest import has_null_key, latest
from gaugeloft.operators.points import latest_measurements, stored_points, unchunk
from gaugeloft.session import settle

VERSION = "batch_id"
REJECTED = "rejected"
BEFORE_ALL = -1
SIGN = "sign"
#: Folders that a filter names at most.
MAX_FOLDERS = 1000

#: Columns that name folders, and their types.
FOLDER_TYPES = {VERSION: LongType(), "tenant_id": StringType(), "file_id": StringType(), "date": DateType()}

SILVER_KEYS = ["vm_id", "window_start"]
GOLD_KEYS = ["vm_id"]
POINT_KEYS = ["file_id", "point_id"]
FILE_KEYS = ["file_id"]
CHUNK_KEYS = ["file_id", "chunk_number"]
MEASUREMENT_KEYS = ["lidar_id", "depth", "measurement_type"]


def write_version(
    df: DataFrame,
    root: str,
    version: int,
    keys: list[str],
    partition_by: list[str] | None = None,
    sort_by: list[str | Column] | None = None,
    rebalance: bool = True,
    looked_up: list[str] | None = None,
    **options: str,
) -> None:
    """Stores one version in a single pass. Rows with a null in the key go to a folder of their own.

    Partition folders are filled through a rebalance, which splits a large tenant or day over
    several tasks and packs small ones together. It can be left out where tasks hold few folders.
    ``options`` are those of the files.
    """
    folders = [REJECTED, *(partition_by or [])]
    marked = df.withColumn(REJECTED, has_null_key(keys).cast("int"))
    if partition_by and rebalance:
        marked = marked.hint("rebalance", *partition_by)
    if sort_by:
        marked = marked.sortWithinPartitions(*folders, *sort_by)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in looked_up or []}
    marked.write.mode("overwrite").options(**blooms, **options).partitionBy(*folders).parquet(f"{root}/versions/{VERSION}={version}")


def _read(spark: SparkSession, path: str, base: str) -> DataFrame:
    """A stored folder. Values of partition folders keep the type they were written with: what looks like
    a number, such as the tenant 007, must not become one."""
    reader = spark.read.option("basePath", base)
    guessed = reader.parquet(path).schema
    fields = [StructField(f.name, FOLDER_TYPES.get(f.name, f.dataType), True) for f in guessed]
    return reader.schema(StructType(fields)).parquet(path)


def _stored(spark: SparkSession, root: str, rejected: int) -> DataFrame:
    stored = _read(spark, f"{root}/versions", f"{root}/versions")
    chosen = stored.filter(F.col(REJECTED) == rejected).drop(REJECTED)
    return chosen.withColumn(VERSION, F.col(VERSION).cast("bigint"))


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """All stored rows with the number of the batch that wrote them."""
    return _stored(spark, root, rejected=0)


def read_latest(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The table as its readers see it: one row per key."""
    return latest(read_versions(spark, root), keys, [VERSION]).drop(VERSION)


def version_range(spark: SparkSession, root: str) -> tuple[int, int]:
    """The numbers of the first and last version there are; -1 for a table without any."""
    first, last = read_versions(spark, root).agg(F.min(VERSION), F.max(VERSION)).first()
    return (BEFORE_ALL, BEFORE_ALL) if last is None else (first, last)


def read_as_of(spark: SparkSession, root: str, keys: list[str], version: int) -> DataFrame:
    """The table as its readers saw it after that version."""
    return latest(read_versions(spark, root).filter(F.col(VERSION) <= version), keys, [VERSION]).drop(VERSION)


def changes(spark: SparkSession, root: str, keys: list[str], since: int, upto: int) -> DataFrame:
    """What versions after ``since``, up to ``upto``, did to the table: its rows with ``sign``.

    A key they wrote has its new row with sign 1 and, if it was there before, its old row with -1; adding signs
    up turns counts of the old state into counts of the new one. Only the new versions are read and, of the older
    ones, the folders of their keys, if these are not too many.
    """
    stored = read_versions(spark, root).filter(F.col(VERSION) <= upto)
    new = stored.filter(F.col(VERSION) > since)
    touched = settle(new.select(*keys).distinct())
    if fits_broadcast(touched):
        touched = F.broadcast(touched)
    old = stored.filter(F.col(VERSION) <= since)
    for column in FOLDER_TYPES.keys() & set(keys):
        folders = [r[0] for r in touched.select(column).distinct().limit(MAX_FOLDERS + 1).collect()]
        if len(folders) <= MAX_FOLDERS:
            old = old.filter(F.col(column).isin(folders))
    old = old.join(touched, keys, "left_semi")
    signed = [latest(rows, keys, [VERSION]).drop(VERSION).withColumn(SIGN, F.lit(sign)) for rows, sign in ((new, 1), (old, -1))]
    return signed[0].unionByName(signed[1])


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rows that could not be stored because a key was null."""
    return _stored(spark, root, rejected=1)


def rewrite(spark: SparkSession, root: str, target: str, keys: list[str], partition_by: list[str] | None = None, looked_up: list[str] | None = None) -> int:
    """Writes the table as its readers see it to the new folder ``target``, as one version of the newest number.

    Rows lie in order of their folders and keys, so that a key's rows lie in few files and row groups, which tell their
    least and greatest keys; of columns ``looked_up`` by single values they also get Bloom filters. The new table takes later batches like any other. The old one is not
    touched: readers change over when the job is done, and it can be deleted once nobody reads it.
    """
    newest = version_range(spark, root)[1]
    order = [*(partition_by or []), *keys]
    ordered = read_latest(spark, root, [*keys, *(partition_by or [])]).repartitionByRange(*order)
    write_version(ordered, target, newest, keys, partition_by, keys, rebalance=False, looked_up=looked_up)
    return newest


def rewrite_silver(spark: SparkSession, root: str, target: str) -> int:
    """Silver in order of day and VM, with Bloom filters on the VM."""
    return rewrite(spark, root, target, SILVER_KEYS, ["date"], ["vm_id"])


def upsert_silver(df: DataFrame, root: str, batch: int) -> None:
    """Silver rows of one batch, in folders by day, newest window first within a VM."""
    dated = df.withColumn("date", F.to_date("window_start"))
    write_version(dated, root, batch, SILVER_KEYS, ["date"], ["vm_id", F.desc("window_start")])


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, [*SILVER_KEYS, "date"])


def upsert_gold(df: DataFrame, root: str, run: int) -> None:
    write_version(df, root, run, GOLD_KEYS)


def mark_progress(spark: SparkSession, root: str, run: int, until: Column, version: int) -> None:
    """Records that gold of this run counts the windows that ended by ``until``, as silver had them after ``version``."""
    row = spark.range(1).select(F.unix_micros(until).alias("until_micros"), F.lit(version).cast("bigint").alias("silver_version"))
    row.write.mode("overwrite").json(f"{root}/progress/run={run}")


def progress_before(spark: SparkSession, root: str, run: int) -> tuple[int, int, int] | None:
    """Run, cut-off in microseconds and silver version of the last finished run before ``run``."""
    try:
        done = spark.read.schema("until_micros bigint, silver_version bigint, run bigint").json(f"{root}/progress")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    last = done.filter(F.col("run") < run).agg(F.max(F.struct("run", "until_micros", "silver_version")).alias("last")).first()["last"]
    return tuple(last) if last else None


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, GOLD_KEYS)


def upsert_points(df: DataFrame, root: str, batch: int, rebalance: bool = True) -> None:
    """Points of one batch with their ``chunk_number``, then a manifest of the chunks it holds.

    A chunk comes whole and once in a batch, and replaces what earlier batches held of it. Points count from when
    their manifest is there, so a batch that is being written or failed half-way shows nothing. The
    manifest is read off one column of the files just written: a row per 10,000 points or so.
    """
    # Ids are half of a stored point, and their hexadecimal digits take half the room with an entropy coder.
    write_version(df, root, batch, POINT_KEYS, ["tenant_id", "file_id"], rebalance=rebalance, compression="zstd")
    spark = df.sparkSession
    try:
        written = _read(spark, f"{root}/versions/{VERSION}={batch}", f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return
    held = written.filter(F.col(REJECTED) == 0).select("tenant_id", *CHUNK_KEYS).distinct()
    held.write.mode("overwrite").parquet(f"{root}/chunks/{VERSION}={batch}")


def upsert_chunks(chunks: DataFrame, root: str, batch: int) -> None:
    """The points of whole chunks, a row each. They are spread over tasks before they get ids of their own, which
    hardly compress and would make up most of that shuffle."""
    named = chunks.withColumn("file_id", file_id(F.col("tenant_id"), F.col("file_name")))
    points = unchunk(named).hint("rebalance", "tenant_id", "file_id")
    upsert_points(stored_points(points, ["chunk_number"]), root, batch, rebalance=False)


def read_points(spark: SparkSession, root: str) -> DataFrame:
    """The points of the last version of each chunk."""
    return _current_points(spark, root).drop("chunk_number")


def _current_points(spark: SparkSession, root: str) -> DataFrame:
    """Points with their chunk.

    Which versions are outdated is settled from the manifests, before any point is read; points then lose those by
    an anti-join and are neither grouped nor, unless very many chunks were sent again, shuffled.
    """
    chunks = spark.read.schema(f"tenant_id string, file_id string, chunk_number int, {VERSION} bigint").parquet(f"{root}/chunks")
    stored = _stored(spark, root, rejected=0)
    finished = settle(chunks.select(VERSION).distinct())
    again = chunks.groupBy(*CHUNK_KEYS).agg(F.max(VERSION).alias("last"), F.count("*").alias("n")).filter("n > 1").drop("n")
    outdated = settle(chunks.join(again, CHUNK_KEYS).filter(F.col(VERSION) < F.col("last")).select(*CHUNK_KEYS, VERSION))
    finished, outdated = (F.broadcast(side) if fits_broadcast(side) else side for side in (finished, outdated))
    return stored.join(finished, VERSION, "left_semi").join(outdated, [*CHUNK_KEYS, VERSION], "left_anti").drop(VERSION)


def rewrite_points(spark: SparkSession, root: str, target: str) -> int:
    """The same for points, which keep the number of their chunk."""
    newest = spark.read.schema(f"{VERSION} bigint").parquet(f"{root}/chunks").agg(F.max(VERSION)).first()[0]
    ordered = _current_points(spark, root).repartitionByRange("tenant_id", *CHUNK_KEYS)
    upsert_points(ordered, target, newest, rebalance=False)
    return newest


def upsert_file_stats(df: DataFrame, root: str, batch: int) -> None:
    write_version(df, root, batch, FILE_KEYS)


def read_file_stats(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, FILE_KEYS)


def upsert_measurements(points: DataFrame, root: str, batch: int, order: list[str]) -> None:
    """Long rows of points; of equal depths the point last in ``order`` stands."""
    write_version(latest_measurements(points, order), root, batch, MEASUREMENT_KEYS)


def read_measurements(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, MEASUREMENT_KEYS)
