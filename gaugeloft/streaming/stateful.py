"""Operators that keep their own state: window averages that lose no late row, and files that are complete or not.

Both see the watermark as a time of their own: the columns they read carry none, so Spark drops no row before
they have looked at it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gaugeloft.functions.measures import ANOMALY_THRESHOLD, is_over
from gaugeloft.operators.silver import WATERMARK, WINDOW
from gaugeloft.schemas import CHUNK_MESSAGE, COMPLETION_MESSAGE
from gaugeloft.session import SETTINGS
from gaugeloft.sinks import keyed
from gaugeloft.sinks.messages import fan_out
from gaugeloft.storage import ship_package

#: Windows of a key that share one state.
WINDOWS_PER_STATE = 256
ON_TIME, LATE = "window", "late"
COMPLETE, SHORT, TIMED_OUT = "complete", "short", "timed out"
# Fixed value: how long a file may wait for what it lacks.
PATIENCE = "10 minutes"

# Spark starts a state processor on the driver, too, in a process that gets none of the shipped files: the
# processors travel as code, so that nothing there has to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


STORE = "spark.sql.streaming.stateStore.providerClass"


def _start(spark: SparkSession, writer: DataStreamWriter, bounded: bool) -> StreamingQuery:
    """Starts a query whose state processors need RocksDB, also in a session that is set to another store.

    A query copies the session's settings when it starts, so the session gets its own back at once.
    """
    kept = spark.conf.get(STORE)
    spark.conf.set(STORE, SETTINGS[STORE])
    try:
        return (writer.trigger(availableNow=True) if bounded else writer).start()
    finally:
        spark.conf.set(STORE, kept)


class _WindowSums(StatefulProcessor):
    """Sums and counts of the open windows of a key; rows of windows that the watermark has closed go out as they are."""

    def __init__(self, micros: int, key: list[str]):
        self.micros, self.key = micros, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "starts array<bigint>, sums array<double>, counts array<bigint>")

    def _load(self) -> dict[int, list]:
        if not self.open.exists():
            return {}
        starts, sums, counts = self.open.get()
        return {s: [x, n] for s, x, n in zip(starts, sums, counts, strict=True)}

    def _keep(self, windows: dict[int, list], closed: int) -> None:
        """Keeps the open windows and wakes when the first of them closes."""
        still = {s: w for s, w in sorted(windows.items()) if s + self.micros > closed}
        if not still:
            self.open.clear()
            return
        self.open.update((list(still), [w[0] for w in still.values()], [w[1] for w in still.values()]))
        self.handle.registerTimer(-(-(min(still) + self.micros) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        windows, touched = self._load(), set()
        for frame in rows:
            starts = frame["at"].to_numpy() // self.micros * self.micros
            late = starts + self.micros <= closed
            if late.any():
                missing = frame["missing"].to_numpy()[late]
                yield self._rows(key, LATE, starts[late], frame["at"].to_numpy()[late], np.where(missing, 0.0, frame["value"].to_numpy()[late]), ~missing)
            known = ~frame["missing"].to_numpy()
            for start in np.unique(starts[~late]):
                mine = (starts == start) & known
                window = windows.setdefault(int(start), [0.0, 0])
                window[0] += float(frame["value"].to_numpy()[mine].sum())
                window[1] += int(mine.sum())
                touched.add(int(start))
        self._keep(windows, closed)
        if touched:
            order = sorted(touched)
            yield self._rows(key, ON_TIME, np.array(order), None, np.array([windows[s][0] for s in order]), np.array([windows[s][1] for s in order]))

    def _rows(self, key, kind: str, starts: np.ndarray, at: np.ndarray | None, total: np.ndarray, count: np.ndarray) -> pd.DataFrame:
        named = {name: [value] * len(starts) for name, value in zip(self.key, key, strict=False)}
        moments = pd.array([None] * len(starts) if at is None else at, dtype="Int64")
        return pd.DataFrame({"kind": kind, **named, "start": starts, "at": moments, "total": total.astype(float), "known": count.astype("int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(self._load(), timerValues.getCurrentWatermarkInMs() * 1000)
        return iter([])


def window_average_and_late(
    readings: DataFrame,
    keys: list[str] | None = None,
    time: str = "event_time",
    value: str = "max_cpu",
    window: str = WINDOW,
    watermark: str = WATERMARK,
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """Window averages of a stream, in update mode, and the rows that came too late for theirs: both in one result.

    ``kind`` is ``window`` for an average, with ``avg_max_cpu`` and ``is_window_anomaly``, and ``late`` for a row, with its
    time and value. A row is late if its window ended by the watermark that its micro-batch began with, which
    is the latest time in earlier batches less the allowed lateness; such a window is final. So every row with
    a time is either in the averages or in the result itself. Windows are those of
    ``window_average``. A key's windows share state 256 at a time, so that a hot key spreads over tasks, and
    windows leave the state when the watermark closes them.
    """
    ship_package(readings.sparkSession)
    keys = keys or ["vm_id"]
    micros = _micros(readings, window)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    number = F.col(value).cast("double")
    # Whole numbers carry no watermark.
    bare = readings.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark).filter(F.col(time).isNotNull()).select(
        *keys, at.alias("at"), F.coalesce(number, F.lit(0.0)).alias("value"), number.isNull().alias("missing")
    )
    sliced = bare.withColumn("slice", F.floor(F.col("at") / (micros * WINDOWS_PER_STATE)))
    kinds = {f.name: f.dataType.simpleString() for f in bare.schema}
    columns = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    out = sliced.groupBy(*keys, "slice").transformWithStateInPandas(
        _WindowSums(micros, keys), f"kind string, {columns}, start bigint, at bigint, total double, known bigint", "Update", "EventTime"
    )
    on_time = F.col("kind") == ON_TIME
    average = F.when(on_time & (F.col("known") > 0), F.col("total") / F.col("known"))
    return out.select(
        "kind",
        *keys,
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros(F.col("start") + micros).alias("window_end"),
        average.alias("avg_max_cpu"),
        F.when(on_time, is_over(average, threshold)).alias("is_window_anomaly"),
        F.timestamp_micros("at").alias(time),
        F.when(~on_time & (F.col("known") > 0), F.col("total")).alias(value),
    )


def _micros(df: DataFrame, interval: str) -> int:
    """Length of an interval without months, in microseconds."""
    epoch = F.lit("1970-01-01 00:00:00+00:00").cast("timestamp")
    return df.sparkSession.range(1).select(F.unix_micros(epoch + F.expr(f"INTERVAL {interval}"))).first()[0]


def run_silver_keeping_late(
    readings: DataFrame,
    root: str,
    late_root: str,
    checkpoint: str,
    keys: list[str] | None = None,
    time: str = "event_time",
    value: str = "max_cpu",
    bounded: bool = False,
    **options,
) -> StreamingQuery:
    """Keeps the silver table current and stores rows that came too late in a table of their own.

    A replayed batch replaces what it had written to either.
    """
    keys = keys or ["vm_id"]

    def each(batch: DataFrame, number: int) -> None:
        silver = batch.filter(F.col("kind") == ON_TIME).drop("kind", time, value)
        late = batch.filter(F.col("kind") == LATE).drop("kind", "avg_max_cpu", "is_window_anomaly")
        fan_out(batch, [lambda _: keyed.upsert_silver(silver, root, number), lambda _: keyed.write_version(late, late_root, number, keys)])

    stream = window_average_and_late(readings, keys, time, value, **options)
    writer = stream.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint)
    return _start(readings.sparkSession, writer, bounded)


def read_late(spark, late_root: str) -> DataFrame:
    return keyed.read_versions(spark, late_root).drop(keyed.VERSION)


class _FileProgress(StatefulProcessor):
    """What has come of a file: its chunks, each counted once, and the totals announced for it."""

    def __init__(self, patience_ms: int):
        self.patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk_number int", "points bigint")
        self.known = handle.getValueState("known", "points bigint, chunks bigint, announced_points bigint, announced_chunks bigint, deadline bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        points, chunks, total, wanted, deadline = self.known.get() if self.known.exists() else (0, 0, None, None, 0)
        before = deadline
        for frame in rows:
            for number, n, announced, parts, at in zip(*(frame[c] for c in ("chunk_number", "points", "total_points", "total_chunks", "at")), strict=True):
                deadline = max(deadline, int(at) + self.patience)
                if not pd.isna(number):
                    had = self.chunks.getValue((int(number),))[0] if self.chunks.containsKey((int(number),)) else None
                    points, chunks = points + int(n) - (had or 0), chunks + (had is None)
                    self.chunks.updateValue((int(number),), (int(n),))
                else:
                    total, wanted = int(announced), int(parts)
        if total is not None and chunks >= wanted and points >= total:
            yield self._told(key, COMPLETE, points, chunks, total, wanted)
            self._forget(before)
            return
        self.known.update((points, chunks, total, wanted, deadline))
        if deadline > before:
            if before:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.known.exists():
            return
        points, chunks, total, wanted, deadline = self.known.get()
        if deadline <= timerValues.getCurrentWatermarkInMs():
            yield self._told(key, TIMED_OUT if total is None else SHORT, points, chunks, total, wanted)
            self._forget(0)

    def _forget(self, timer: int) -> None:
        if timer:
            self.handle.deleteTimer(timer)
        self.known.clear()
        self.chunks.clear()

    @staticmethod
    def _told(key, verdict: str, points: int, chunks: int, total: int | None, wanted: int | None) -> pd.DataFrame:
        announced = {name: pd.array([value], dtype="Int64") for name, value in (("announced_points", total), ("announced_chunks", wanted))}
        return pd.DataFrame({"tenant_id": [key[0]], "file_name": [key[1]], "verdict": [verdict], "received_points": [points], "received_chunks": [chunks], **announced})


def file_completeness(chunks: DataFrame, completions: DataFrame, patience: str = PATIENCE, watermark: str = WATERMARK) -> DataFrame:
    """Tells of every file, once, whether all of it came: ``tenant_id, file_name, verdict`` and what came of what was announced.

    Takes the messages of both topics, with the time they were sent. A file is ``complete`` as soon as the chunks and points of its
    completion message are there, whichever came first. If for ``patience`` after its last message something
    lacks it is ``short``, or ``timed out`` if no completion came either; time is that of the messages, and that of the
    topic that lags behind, so a topic that falls silent ends no wait. A chunk sent again counts once, with its last
    number of points. What comes after a verdict begins the file anew. Chunks travel as their number of points only.
    """
    ship_package(chunks.sparkSession)

    def parsed(messages: DataFrame, schema, wanted: Column) -> DataFrame:
        timed = messages.withColumn("sent", F.col("timestamp").cast("timestamp")).withWatermark("sent", watermark)
        data = timed.withColumn("data", F.from_json(F.col("value").cast("string"), schema))
        # A condition on the time stays above the watermark, so that messages it turns away move the time on, too.
        return data.filter(F.when(F.col("sent").isNotNull(), wanted))

    at = F.unix_millis("sent").alias("at")
    none = [F.lit(None).cast(t) for t in ("int", "bigint")]
    held = parsed(chunks, CHUNK_MESSAGE, F.col("data.points").isNotNull()).select(
        "data.tenant_id", "data.file_name", F.coalesce("data.chunk_number", F.lit(0)).alias("chunk_number"), F.size("data.points").cast("bigint").alias("points"),
        none[1].alias("total_points"), none[1].alias("total_chunks"), at,
    )
    done = parsed(completions, COMPLETION_MESSAGE, F.col("data.status") == "completed").select(
        "data.tenant_id", "data.file_name", none[0].alias("chunk_number"), none[1].alias("points"),
        *[F.coalesce(f"data.{c}", F.lit(0).cast("bigint")).alias(c) for c in ("total_points", "total_chunks")], at,
    )
    return held.unionByName(done).groupBy("tenant_id", "file_name").transformWithStateInPandas(
        _FileProgress(_micros(chunks, patience) // 1000),
        "tenant_id string, file_name string, verdict string, received_points bigint, received_chunks bigint, announced_points bigint, announced_chunks bigint",
        "Append", "EventTime",
    )


def run_completeness(verdicts: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, bounded: bool = False) -> StreamingQuery:
    """Hands every micro-batch of verdicts to ``sink`` with its number."""
    writer = verdicts.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    return _start(verdicts.sparkSession, writer, bounded)
