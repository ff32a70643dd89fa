"""Flags, ratios, labels and formatted numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and texts of the recommendation, bytes assumed per stored point.
ANOMALY_THRESHOLD = 90.0
FREQUENCY_THRESHOLD = 0.8
UPGRADE = "Upgrade to higher CPU capacity"
ADEQUATE = "Current configuration is adequate"
POINT_BYTES = 24 * 8
MEGABYTE = 1048576


def is_over(value: Column, threshold: float = ANOMALY_THRESHOLD) -> Column:
    """Strictly above the threshold; null counts as not above, NaN as above."""
    return F.coalesce(value > threshold, F.lit(False))


def overload_ratio(anomalies: Column, total: Column) -> Column:
    return anomalies / total


def recommendation(ratio: Column, threshold: float = FREQUENCY_THRESHOLD) -> Column:
    return F.when(ratio >= threshold, UPGRADE).otherwise(ADEQUATE)


def throughput(size_mb: Column, seconds: Column) -> Column:
    """MB per second to two places; zero when no time has passed."""
    rate = F.when(seconds > 0, F.try_divide(size_mb, seconds)).otherwise(0.0)
    return F.round(rate, 2)


def percent_text(ratio: Column) -> Column:
    """Percent with two places, rounded as the binary value lies; one exactly halfway takes the even text.

    The percent value is split into two halves of 26 bits, so that its distance from the middle
    between two texts comes out exactly.
    """
    percent = ratio * 100
    wide = percent * float((1 << 27) + 1)
    high = wide - (wide - percent)
    low = percent - high
    below = F.floor(percent * 100).cast("double")
    beyond = (high * 200 - (below * 2 + 1)) + low * 200
    up = (beyond > 0) | ((beyond == 0) & (below % 2 == 1))
    return F.format_string("%.2f%%", F.when(up, below + 1).otherwise(below) / 100)


def estimated_mb(points: Column) -> Column:
    return points * POINT_BYTES / MEGABYTE


def run_status(points: Column) -> Column:
    return F.when(points > 0, "success").otherwise("error")


def latency_seconds(ingested: Column, now: Column | None = None) -> Column:
    """Seconds between arrival and ``now``, by default the current time."""
    now = F.current_timestamp() if now is None else now
    return F.unix_micros(now.cast("timestamp")) / 1e6 - F.unix_micros(ingested.cast("timestamp")) / 1e6
