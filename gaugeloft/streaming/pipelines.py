"""The running pipelines: readings to silver, silver to gold, LAS files to points."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeloft.functions.convert import to_message, utc_time
from gaugeloft.functions.naming import stem_of
from gaugeloft.operators import gold as gold_ops
from gaugeloft.operators.joins import join_small
from gaugeloft.operators.latest import latest
from gaugeloft.operators.points import CHUNK_POINTS, file_stats, in_chunks, stored_points
from gaugeloft.operators.quality import stop_on_drift
from gaugeloft.operators.runs import chunk_record, completed_record, ingestion_record
from gaugeloft.operators.silver import WATERMARK, alert_rate, row_alerts, silver_text
from gaugeloft.sinks import keyed
from gaugeloft.sinks.files import log_batch
from gaugeloft.sinks.messages import fan_out, write_messages
from gaugeloft.session import settle
from gaugeloft.sources.las import LABELS, SPLIT_BYTES, chunks_of, file_totals_of, points_of
from gaugeloft.sources.topics import ALERT_TOPIC, CRITICAL_TOPIC, SILVER_TOPIC, sent_order, store_messages

TopicWriter = Callable[[DataFrame, int], None]


def _start(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str, bounded: bool, name: str | None) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def silver_sink(root: str, topic: TopicWriter | None = None) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch of silver to the keyed table and, if given, hands it to a topic writer too.

    Errors are raised: the batch is not marked done and runs again.
    """

    def each(batch: DataFrame, number: int) -> None:
        sinks = [lambda df: keyed.upsert_silver(df, root, number)]
        if topic:
            sinks.append(lambda df: topic(silver_text(df), number))
        fan_out(batch, sinks)

    return each


def stored_topic(path: str, topic: str = SILVER_TOPIC, key: str = "vm_id") -> TopicWriter:
    """Topic writer for places without a broker: one folder of message rows per batch, replaced on replay."""

    def each(df: DataFrame, number: int) -> None:
        store_messages(to_message(df, key), topic, path, number)

    return each


def broker_topic(topic: str, key: str = "vm_id", **options: str) -> TopicWriter:
    """Topic writer for a broker; ``options`` name it. A replayed batch is sent again."""
    return lambda df, number: write_messages(df, topic, key, **options)


def run_silver(
    silver: DataFrame,
    root: str,
    checkpoint: str,
    topic: TopicWriter | None = None,
    bounded: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Keeps the silver table current from a stream of window averages.

    ``bounded`` processes what is there now and stops; otherwise the query runs on.
    """
    return _start(silver, silver_sink(root, topic), checkpoint, "update", bounded, name)


def run_alerts(readings: DataFrame, path: str, checkpoint: str, bounded: bool = False, threshold: float = 90.0) -> StreamingQuery:
    """Row alerts of a stream as messages of the alert topic."""
    return _start(row_alerts(readings, threshold=threshold), stored_topic(path, ALERT_TOPIC), checkpoint, "append", bounded, None)


def run_critical(
    readings: DataFrame, path: str, checkpoint: str, window: str, limit: float, bounded: bool = False, watermark: str = WATERMARK
) -> StreamingQuery:
    """An event for every window whose alert rate exceeds the limit."""
    critical = alert_rate(readings, window, limit, watermark=watermark)
    sink = stored_topic(path, CRITICAL_TOPIC, key="window_start")
    return _start(critical, lambda df, n: sink(df.filter("is_critical"), n), checkpoint, "update", bounded, None)


def guarded(each: Callable[[DataFrame, int], None], fields: list[str], limit: float = 0.1) -> Callable[[DataFrame, int], None]:
    """A micro-batch callback that refuses batches in which a critical field is empty too often."""

    def checked(batch: DataFrame, number: int) -> None:
        stop_on_drift(batch, fields, limit)
        each(batch, number)

    return checked


def run_gold(
    silver: DataFrame,
    root: str,
    run: int,
    start: datetime | None = None,
    end: datetime | None = None,
    topic: TopicWriter | None = None,
) -> None:
    """One batch run: gold from silver, once computed, to the keyed table and, if given, a topic."""
    gold = gold_ops.stamped(gold_ops.overload(silver, start, end))
    sinks = [lambda df: keyed.upsert_gold(df, root, run)]
    if topic:
        sinks.append(lambda df: topic(df, run))
    fan_out(gold, sinks)


def run_gold_incremental(spark: SparkSession, silver_root: str, gold_root: str, run: int, until: datetime) -> None:
    """Brings the gold table up to ``until`` and to the newest version of silver, reading only what that changes.

    The run before counted the windows that ended by its cut-off, as silver had them then. To its counts come the windows
    that ended since, as they were then, and of all windows that silver has written since the new row is added and
    the old one taken back: so a window that is corrected, or comes late, counts right after any cut-off. The
    cut-off never goes back: a run with an earlier ``until`` keeps the last one, and still takes corrections.
    Runs are numbered upwards. One that failed, or is repeated, starts again from the last one before it that
    finished. Without such a run everything is counted, and so it is where silver was rewritten since without the
    versions that run had seen.
    """
    wanted = until if until.tzinfo else until.replace(tzinfo=timezone.utc)
    oldest, version = keyed.version_range(spark, silver_root)
    keys = [*keyed.SILVER_KEYS, "date"]
    last = keyed.progress_before(spark, gold_root, run)
    if last is None or last[2] < oldest:
        silver = keyed.read_as_of(spark, silver_root, keys, version)
        gold = gold_ops.overload(gold_ops.ended_by(silver, wanted))
    else:
        last_run, micros, seen = last
        covered = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=micros)
        wanted = max(wanted, covered)
        ended = gold_ops.finished_between(keyed.read_as_of(spark, silver_root, keys, seen), covered, wanted).withColumn(keyed.SIGN, F.lit(1))
        changed = gold_ops.ended_by(keyed.changes(spark, silver_root, keys, seen, version), wanted)
        added = gold_ops.signed_counts(ended.unionByName(changed), sign=keyed.SIGN)
        gold = gold_ops.add_counts(keyed.read_as_of(spark, gold_root, keyed.GOLD_KEYS, last_run), added)
    reached = utc_time(wanted).cast("timestamp")
    dated = gold.withColumns({"date_range_start": F.lit(None).cast("timestamp"), "date_range_end": reached})
    keyed.upsert_gold(gold_ops.stamped(settle(dated)), gold_root, run)
    keyed.mark_progress(spark, gold_root, run, reached, version)


def silver_then_gold(silver: DataFrame, silver_root: str, gold_root: str, checkpoint: str, run: int = 0, topic: TopicWriter | None = None) -> None:
    """Drains a bounded stream, then runs the batch job on the finished table."""
    run_silver(silver, silver_root, checkpoint, bounded=True).awaitTermination()
    run_gold(keyed.read_silver(silver.sparkSession, silver_root), gold_root, run, topic=topic)


def load_measurements(points: DataFrame, root: str, run: int) -> None:
    """Points of LAS files to the table of long measurements, the file's stem naming the scanner."""
    single = points.select(
        stem_of(F.col("file_name")).alias("lidar_id"),
        F.col("scaled_z").alias("z"),
        F.col("scaled_x").alias("x"),
        F.col("scaled_y").alias("y"),
        "point_index",
    )
    keyed.upsert_measurements(single, root, run, ["point_index"])


def run_las(
    files: DataFrame,
    root: str,
    checkpoint: str,
    chunk_points: int = CHUNK_POINTS,
    bounded: bool = False,
    split_bytes: int = SPLIT_BYTES,
    log_path: str | None = None,
) -> StreamingQuery:
    """Arriving LAS files to the points table, with the ids their chunk messages would give.

    A task reads a part of one file, so it writes to one folder and nothing is shuffled. With
    ``log_path`` a bad file is logged there and the others go on; without it a bad file ends the
    query, as nobody would hear of it otherwise.
    """

    def each(batch: DataFrame, number: int) -> None:
        points = points_of(batch, split_bytes=split_bytes, skip_bad=log_path is not None)
        keyed.upsert_points(stored_points(in_chunks(points, size=chunk_points), ["chunk_number"]), root, number, rebalance=False)
        if log_path:
            bad = file_totals_of(batch, chunk_points).filter("error IS NOT NULL")
            log_batch(ingestion_record(_as_runs(bad, F.lit(0.0)), F.current_timestamp()), log_path, number)

    return _start(files, each, checkpoint, "append", bounded, None)


def _as_runs(totals: DataFrame, seconds: Column) -> DataFrame:
    """File totals as ingestion runs, the file's error among them."""
    errors = F.array_compact(F.array("error"))
    return totals.withColumns({"ingestion_time_sec": seconds, "records_processed": F.col("total_points"), "errors": errors})


def run_las_topics(
    files: DataFrame,
    chunk_topic: TopicWriter,
    completion_topic: TopicWriter,
    log_path: str,
    checkpoint: str,
    chunk_points: int = CHUNK_POINTS,
    bounded: bool = False,
) -> StreamingQuery:
    """Arriving LAS files to chunk messages, then one completion message and one log row per file.

    The processing time of a file runs from the first of its chunks that a task began to the last that one
    ended. A file that is no LAS file gets a log row with status ``error`` and no completion; one that is
    cut off is completed with the points it holds, and logged with what is missing.
    """

    def each(batch: DataFrame, number: int) -> None:
        chunks = settle(chunks_of(batch, chunk_points, skip_bad=True, timed=True))
        sent = F.unix_micros(F.current_timestamp()) / 1e6
        chunk_topic(chunks.drop("began", "ended").withColumn("timestamp", sent), number)
        taken = chunks.groupBy(*LABELS).agg((F.max("ended") - F.min("began")).alias("seconds"))
        totals = settle(join_small(file_totals_of(batch, chunk_points), taken, LABELS, "left"))
        seconds = F.coalesce("seconds", F.lit(0.0))
        told = totals.select(*LABELS, "total_points", "total_chunks", "file_size_mb", "error", "declared_points", seconds.alias("processing_time_sec"))
        whole = told.filter("error IS NULL OR declared_points > 0").drop("error", "declared_points")
        completion_topic(whole.withColumn("status", F.lit("completed")), number)
        log_batch(ingestion_record(_as_runs(totals, seconds), F.current_timestamp()), log_path, number)

    return _start(files, each, checkpoint, "append", bounded, None)


def run_chunk_topics(
    chunks: DataFrame,
    completions: DataFrame,
    points_root: str,
    stats_root: str,
    checkpoint: str,
    bounded: bool = False,
    log_path: str | None = None,
) -> list[StreamingQuery]:
    """Chunk and completion messages side by side, each with its own query and checkpoint.

    ``log_path`` also gets a log row per stored chunk and per completed file.
    """

    def each_chunk(batch: DataFrame, number: int) -> None:
        """Of a chunk sent again within the batch the last one counts."""
        begin = time.monotonic()

        def log(df: DataFrame) -> None:
            seconds = F.lit(time.monotonic() - begin)
            log_batch(chunk_record(df, F.current_timestamp(), seconds), f"{log_path}/consumer", number)

        last = latest(batch, [*LABELS, "chunk_number"], sent_order(batch))
        fan_out(last, [lambda df: keyed.upsert_chunks(df, points_root, number), *([log] if log_path else [])])

    def each_completion(batch: DataFrame, number: int) -> None:
        last = latest(batch.filter(F.col("status") == "completed"), LABELS, sent_order(batch))

        def log(df: DataFrame) -> None:
            log_batch(completed_record(df, F.current_timestamp()), f"{log_path}/completed", number)

        fan_out(last, [lambda df: keyed.upsert_file_stats(file_stats(df), stats_root, number), *([log] if log_path else [])])

    return [
        _start(chunks, each_chunk, f"{checkpoint}/points", "append", bounded, None),
        _start(completions, each_completion, f"{checkpoint}/stats", "append", bounded, None),
    ]


def wait_for_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()
