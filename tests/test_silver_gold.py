import os
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeloft.functions.convert import to_message
from gaugeloft.operators import gold, silver
from gaugeloft.sinks.messages import show
from gaugeloft.sources.topics import as_envelope

T0 = datetime(2019, 1, 1)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def readings(spark, rows):
    return spark.createDataFrame(rows, "vm_id string, event_time timestamp, max_cpu double")


def test_windows_average_and_flag(spark):
    rows = [("a", T0, 80.0), ("a", T0 + timedelta(seconds=179), 100.0), ("a", T0 + timedelta(seconds=180), 95.0), ("b", T0, None), (None, T0, 1.0)]
    got = {(r.vm_id, r.window_start): (r.avg_max_cpu, r.is_window_anomaly, r.window_end) for r in silver.window_average(readings(spark, rows)).collect()}
    assert got[("a", T0)] == (90.0, False, T0 + timedelta(minutes=3))
    assert got[("a", T0 + timedelta(minutes=3))][:2] == (95.0, True)
    assert got[("b", T0)][:2] == (None, False)
    assert got[(None, T0)][:2] == (1.0, False)


def test_rows_without_time_are_in_no_window(spark):
    assert silver.window_average(readings(spark, [("a", None, 99.0)])).count() == 0


@pytest.mark.parametrize("drop,average,flag", [(False, "nan", True), (True, "50.0", False)])
def test_nan(spark, drop, average, flag):
    rows = readings(spark, [("a", T0, float("nan")), ("a", T0, 50.0)])
    row = silver.window_average(rows, drop_nan=drop).first()
    assert (str(row.avg_max_cpu), row.is_window_anomaly) == (average, flag)


def test_repeated_readings_shift_the_mean_unless_made_unique(spark):
    rows = readings(spark, [("a", T0, 90.0), ("a", T0, 90.0), ("a", T0 + timedelta(seconds=1), 30.0)])
    assert silver.window_average(rows).first().avg_max_cpu == 70.0
    assert silver.window_average(rows, unique_readings=True).first().avg_max_cpu == 60.0


def test_tenants_do_not_mix(spark):
    rows = spark.createDataFrame([("t1", "a", T0, 10.0), ("t2", "a", T0, 20.0)], "tenant_id string, vm_id string, event_time timestamp, max_cpu double")
    assert sorted(r.avg_max_cpu for r in silver.window_average(rows, ["tenant_id", "vm_id"]).collect()) == [10.0, 20.0]


def test_readings_from_messages(spark):
    texts = ['{"timestamp": 10, "vm_id": "a", "min_cpu": 1, "max_cpu": 90.5, "avg_cpu": 2}', "garbage"]
    df = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    first, second = silver.readings_from_messages(df).collect()
    assert (first.event_time, first.is_anomaly) == (T0 + timedelta(seconds=10), True)
    assert (second.event_time, second.is_anomaly) == (None, False)


def test_row_alerts_and_rate(spark):
    rows = readings(spark, [("a", T0, 95.0), ("a", T0, 90.0), ("b", T0, None), ("c", T0, 99.0)])
    assert sorted(r.vm_id for r in silver.row_alerts(rows).collect()) == ["a", "c"]
    rate = silver.alert_rate(rows, "3 minutes", 0.4).first()
    assert (rate.readings, rate.alerts, rate.alert_rate, rate.is_critical) == (4, 2, 0.5, True)
    assert not silver.alert_rate(rows, "3 minutes", 0.5).first().is_critical


def windows(spark, rows):
    frame = spark.createDataFrame(rows, "vm_id string, minute int, is_window_anomaly boolean")
    start = F.lit(T0) + F.make_dt_interval(mins=F.col("minute"))
    return frame.select("vm_id", start.alias("window_start"), (start + F.expr("INTERVAL 3 MINUTES")).alias("window_end"), F.lit(1.0).alias("avg_max_cpu"), "is_window_anomaly")


def test_gold_ratio_and_recommendation(spark):
    rows = [("a", 3 * i, i < 8) for i in range(10)] + [("b", 3 * i, i < 7) for i in range(10)] + [("c", 0, None)]
    got = {r.vm_id: r for r in gold.overload(windows(spark, rows)).collect()}
    assert (got["a"].overload_frequency, got["a"].recommendation) == (0.8, "Upgrade to higher CPU capacity")
    assert (got["b"].overload_frequency, got["b"].recommendation) == (0.7, "Current configuration is adequate")
    assert (got["c"].total_windows, got["c"].anomaly_windows) == (1, 0)
    assert got["a"].date_range_start is None


def test_range_ends_are_included_and_crossing_windows_left_out(spark):
    frame = windows(spark, [("a", 0, True), ("a", 3, True), ("a", 6, True)])
    start, end = T0 + timedelta(minutes=3), T0 + timedelta(minutes=6)
    row = gold.overload(frame, start, end).first()
    assert (row.total_windows, row.date_range_start, row.date_range_end) == (1, start, end)
    assert gold.overload(frame, start, None).first().total_windows == 3
    assert gold.overload(frame, T0 + timedelta(minutes=1), end).first().total_windows == 1


def test_lookup_of_one_vm(spark):
    frame = windows(spark, [("a", 0, True), ("a", 3, True), ("b", 0, True)])
    assert gold.windows_of(frame, "a").count() == 2
    assert gold.windows_of(frame, "a", T0 + timedelta(minutes=3), T0 + timedelta(minutes=3)).count() == 1
    assert [r.window_start for r in gold.preview(frame, 1).collect()] == [T0 + timedelta(minutes=3)]


def test_report_is_shown_whole(spark, capsys):
    show(gold.report(gold.overload(windows(spark, [("a" * 30, 0, True)]))).select("vm_id", "overload_frequency"))
    assert "a" * 30 in capsys.readouterr().out


def test_time_bounds_reach_the_files(spark, path):
    rows = readings(spark, [("a", T0 + timedelta(minutes=i), float(i)) for i in range(30)])
    rows.write.parquet(f"{path}/r")
    stored = spark.read.parquet(f"{path}/r")
    start, end = T0 + timedelta(minutes=6), T0 + timedelta(minutes=21)
    bounded = silver.window_average(silver.within(stored, start, end))
    assert "GreaterThanOrEqual(event_time" in bounded._jdf.queryExecution().toString()
    whole = gold.in_range(silver.window_average(stored), start, end)
    assert sorted(gold.in_range(bounded, start, end).collect()) == sorted(whole.collect()) and whole.count() == 5


def test_lookback(spark):
    assert gold.lookback(24, datetime(2024, 1, 2)) == (datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_incremental_counts_equal_one_run(spark):
    frame = windows(spark, [("a", 3 * i, i % 3 == 0) for i in range(12)] + [("b", 30, True)])
    cut, end = T0 + timedelta(minutes=15), T0 + timedelta(days=1)
    first = gold.overload(gold.finished_between(frame, T0, cut))
    second = gold.overload(gold.finished_between(frame, cut, end))
    assert sorted(gold.add_counts(first, second).collect()) == sorted(gold.overload(frame).collect())


def test_topic_versions(spark):
    def version(average, flag):
        return spark.createDataFrame([("a", "2019-01-01 00:00:00", "2019-01-01 00:03:00", average, flag)], "vm_id string, window_start string, window_end string, avg_max_cpu double, is_window_anomaly boolean")

    both = to_message(version(93.0, True), "vm_id").unionByName(to_message(version(65.0, False), "vm_id"))
    topic = as_envelope(both, "silver")
    once = gold.silver_from_messages(topic).collect()
    assert [(r.avg_max_cpu, r.window_start) for r in once] == [(65.0, T0)]
    every = gold.overload(gold.silver_from_messages(topic, dedup=False)).first()
    assert (every.total_windows, every.anomaly_windows) == (2, 1)


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_ranges_do_not_depend_on_the_drivers_clock(zone, tmp_path):
    """The same rows as in UTC, from a driver whose own zone is another."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
import __spark_entry__ as entry
from gaugeloft.session import build_session
spark = build_session("zone", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": {str(tmp_path)!r}}})
from pyspark.sql import functions as F
for name in ("gold_range", "gold_lookback", "vm_lookup", "message_latency"):
    df = entry.queries()[name](spark, {SF!r})
    print("ROWS", name, df.count(), df.select(F.bit_xor(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]))).first()[0])
"""
    got = []
    for tz in ("UTC", zone):
        done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, env={**os.environ, "TZ": tz})
        got.append([line for line in done.stdout.splitlines() if line.startswith("ROWS")])
    assert len(got[0]) == 4 and got[0] == got[1], done.stderr[-1500:]
