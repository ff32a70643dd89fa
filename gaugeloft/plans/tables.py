"""The driver tables, seen as readings, points, runs and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.functions.convert import TRACE_START, to_message
from gaugeloft.functions.measures import throughput
from gaugeloft.operators.faults import damage
from gaugeloft.operators.points import chunk
from gaugeloft.operators.ranks import dense_position
from gaugeloft.session import fresh_dir, pin_utc
from gaugeloft.sources.topics import RAW_TOPIC, as_envelope

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FAULT_PERCENT = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the driver tables have them."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CPU readings of many tenants."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("tenant_id"),
        F.col("user_id").alias("vm_id"),
        F.col("ts").alias("event_time"),
        F.col("value").alias("max_cpu"),
    )


def reading_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of the raw topic, times in whole seconds since the start of the trace."""
    value = F.col("value")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - TRACE_START
    rows = table(spark, sf_dir, "events").select(
        seconds.alias("timestamp"),
        F.col("user_id").cast("string").alias("vm_id"),
        (value / 2).alias("min_cpu"),
        value.alias("max_cpu"),
        value.alias("avg_cpu"),
    )
    return as_envelope(to_message(rows, "vm_id"), RAW_TOPIC)


def file_count(spark: SparkSession) -> int:
    """Files to spread a staged table over: as many as the cluster's shuffles have tasks, a few at least."""
    return max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))


def staged_messages(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The raw topic stored as that many files in order of time, for streams to read bit by bit."""
    path = fresh_dir(spark, "raw-topic")
    rows = reading_messages(spark, sf_dir)
    second = F.get_json_object(F.col("value").cast("string"), "$.timestamp").cast("bigint")
    rows.repartitionByRange(files, second).write.parquet(path)
    return path


def staged_lines(spark: SparkSession, sf_dir: str) -> str:
    """Events as CSV lines in one directory per tenant, some of them damaged."""
    path = fresh_dir(spark, "csv")
    number = F.coalesce(F.col("value").cast("string"), F.lit(""))
    line = F.concat_ws(",", F.col("event_id"), F.concat(F.lit("vm"), F.col("user_id")), number, number, number)
    lines = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tenant"), damage(line, F.col("event_id"), FAULT_PERCENT).alias("value")
    )
    lines.write.partitionBy("tenant").text(path)
    return path


def points(spark: SparkSession, sf_dir: str, values: list[str]) -> DataFrame:
    """Line items as points of one file per return flag, numbered in key order."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, *values, F.col("l_returnflag").alias("flag"))
    return dense_position(rows, ["flag"], LINE_ORDER, "point_index")


def point_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points as chunk messages."""
    fields = points(spark, sf_dir, ["l_quantity", "l_extendedprice"]).select(
        F.concat(F.lit("tenant"), "flag").alias("tenant_id"),
        F.concat("flag", F.lit(".las")).alias("file_name"),
        "point_index",
        F.col("l_partkey").cast("double").alias("X"),
        F.col("l_suppkey").cast("double").alias("Y"),
        F.col("l_quantity").alias("Z"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("intensity"),
        F.when(F.col("l_linenumber") != 4, F.col("l_linenumber")).alias("classification"),
        F.col("l_linenumber").alias("point_source_id"),
    )
    return chunk(fields, ["tenant_id", "file_name"], "point_index")


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as completion messages; those still pending count as failed."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("tenant"), "o_orderpriority").alias("tenant_id"),
        F.concat(F.lit("order"), F.col("o_orderkey"), F.lit(".las")).alias("file_name"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed").alias("status"),
        F.col("o_custkey").alias("total_points"),
        F.ceil(F.col("o_custkey") / 100).alias("total_chunks"),
        F.col("o_totalprice").alias("file_size_mb"),
        F.col("o_custkey").cast("double").alias("processing_time_sec"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ingestion runs of one tenant per priority; those still pending failed with two errors."""
    failed = F.col("o_orderstatus") == "P"
    errors = F.array(
        F.concat(F.lit("timeout after "), F.col("o_custkey"), F.lit(" s")),
        F.concat(F.lit("file order"), F.col("o_orderkey"), F.lit(" incomplete")),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("run_time"),
        F.col("o_orderpriority").alias("tenant_id"),
        F.concat(F.lit("order"), F.col("o_orderkey")).alias("file_name"),
        F.col("o_totalprice").alias("file_size_mb"),
        F.col("o_custkey").cast("double").alias("ingestion_time_sec"),
        throughput(F.col("o_totalprice"), F.col("o_custkey").cast("double")).alias("throughput_mb_sec"),
        F.when(failed, 0).otherwise(F.col("o_custkey")).alias("records_processed"),
        F.when(failed, "error").otherwise("success").alias("status"),
        F.when(failed, errors).otherwise(F.array().cast("array<string>")).alias("errors"),
        "o_orderstatus",
    )
