"""Window averages to one recommendation per key, and lookups in both tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.functions.convert import parse_json, text_to_time, utc_time
from gaugeloft.functions.measures import FREQUENCY_THRESHOLD, overload_ratio, percent_text, recommendation
from gaugeloft.operators.latest import latest
from gaugeloft.schemas import SILVER_MESSAGE
from gaugeloft.sources.topics import sent_order

# Hours a run looks back, and rows a preview shows.
LOOKBACK_HOURS = 24
PREVIEW_ROWS = 100


def silver_from_messages(messages: DataFrame, dedup: bool = True) -> DataFrame:
    """Silver rows of a topic with real times.

    Windows are sent again whenever they change. ``dedup`` keeps the last message of each window;
    without it every message counts.
    """
    order = sent_order(messages) if dedup else []
    parsed = parse_json(messages, "value", SILVER_MESSAGE, keep=order)
    timed = parsed.withColumns({c: text_to_time(F.col(c)) for c in ("window_start", "window_end")})
    return latest(timed, ["vm_id", "window_start"], order).drop(*order) if dedup else timed


def lookback(hours: int = LOOKBACK_HOURS, as_of: datetime | None = None) -> tuple[datetime, datetime]:
    end = as_of or datetime.now(timezone.utc)
    return end - timedelta(hours=hours), end


def in_range(silver: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Windows wholly inside the range, both ends included; no range keeps everything."""
    if start is None or end is None:
        return silver
    return _on_days(silver, start, end).filter((F.col("window_start") >= utc_time(start)) & (F.col("window_end") <= utc_time(end)))


def _on_days(silver: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Only the day folders a range of window starts touches, where the table has them."""
    if "date" not in silver.columns:
        return silver
    first, last = (utc_time(t).cast("timestamp") for t in (start, end))
    return silver.filter(F.col("date").between(F.to_date(first), F.to_date(last)))


def overload(
    silver: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    keys: list[str] | None = None,
    threshold: float = FREQUENCY_THRESHOLD,
) -> DataFrame:
    """Per key: windows, anomalous windows, their ratio and the recommendation."""
    keys = keys or ["vm_id"]
    counts = in_range(silver, start, end).groupBy(*keys).agg(
        F.count("*").alias("total_windows"), F.count_if("is_window_anomaly").alias("anomaly_windows")
    )
    return _judged(counts, keys, start, end, threshold)


def _judged(counts: DataFrame, keys: list[str], start, end, threshold: float) -> DataFrame:
    ratio = overload_ratio(F.col("anomaly_windows"), F.col("total_windows"))
    ranged = start is not None and end is not None
    return counts.select(
        *keys,
        (utc_time(start) if ranged else F.lit(None)).cast("timestamp").alias("date_range_start"),
        (utc_time(end) if ranged else F.lit(None)).cast("timestamp").alias("date_range_end"),
        "total_windows",
        "anomaly_windows",
        ratio.alias("overload_frequency"),
        recommendation(ratio, threshold).alias("recommendation"),
    )


def stamped(gold: DataFrame) -> DataFrame:
    return gold.withColumn("processed_time", F.current_timestamp())


def finished_between(silver: DataFrame, after: datetime, until: datetime, longest: timedelta = timedelta(days=1)) -> DataFrame:
    """Windows that ended since the last run, up to the new cut-off.

    Where the table has day folders only those are read in which such a window may start; ``longest``
    is the longest window.
    """
    if "date" in silver.columns:
        silver = _on_days(silver, after - longest, until)
    return silver.filter((F.col("window_end") > utc_time(after)) & (F.col("window_end") <= utc_time(until)))


def ended_by(silver: DataFrame, until: datetime) -> DataFrame:
    return silver.filter(F.col("window_end") <= utc_time(until))


def signed_counts(windows: DataFrame, keys: list[str] | None = None, sign: str = "sign") -> DataFrame:
    """Counts of windows to add, less those to take back."""
    flagged = F.when(F.col("is_window_anomaly"), F.col(sign)).otherwise(0)
    return windows.groupBy(*(keys or ["vm_id"])).agg(F.sum(sign).alias("total_windows"), F.sum(flagged).alias("anomaly_windows"))


def add_counts(previous: DataFrame, fresh: DataFrame, keys: list[str] | None = None, threshold: float = FREQUENCY_THRESHOLD) -> DataFrame:
    """Gold from earlier counts and counts to add, which may be negative; a key left without windows goes."""
    keys = keys or ["vm_id"]
    columns = [*keys, "total_windows", "anomaly_windows"]
    counts = previous.select(columns).unionByName(fresh.select(columns)).groupBy(*keys).agg(
        F.sum("total_windows").alias("total_windows"), F.sum("anomaly_windows").alias("anomaly_windows")
    )
    return _judged(counts.filter("total_windows > 0"), keys, None, None, threshold)


def windows_of(silver: DataFrame, vm_id, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Windows of one VM, optionally those starting within a range, both ends included."""
    mine = silver.filter(F.col("vm_id") == F.lit(vm_id))
    if start is not None and end is not None:
        mine = _on_days(mine, start, end).filter(F.col("window_start").between(utc_time(start), utc_time(end)))
    return mine


def newest_first(silver: DataFrame) -> DataFrame:
    return silver.orderBy("vm_id", F.desc("window_start"))


def preview(silver: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return newest_first(silver).limit(rows)


def report(gold: DataFrame) -> DataFrame:
    """Gold rows with the frequency as percent text."""
    return gold.withColumn("overload_frequency", percent_text(F.col("overload_frequency")))
