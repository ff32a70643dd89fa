import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeloft.functions.convert import TRACE_START
from gaugeloft.functions.measures import is_over
from gaugeloft.operators import gold
from gaugeloft.operators.silver import readings_from_messages, window_average
from gaugeloft.schemas import ENVELOPE
from gaugeloft.sinks import keyed
from gaugeloft.sinks.messages import console
from gaugeloft.streaming import pipelines
from gaugeloft.streaming.monitoring import MetricsListener, observed, read_metrics

T0 = datetime(2019, 1, 1)
STAMP = 1_700_000_000


class Topic:
    """One file of messages per micro-batch, read in the order they were sent."""

    def __init__(self, spark, path):
        self.spark, self.dir, self.sent = spark, f"{path}/in", 0
        os.makedirs(self.dir)

    def send(self, *readings, raw=()):
        texts = [json.dumps({"timestamp": s, "vm_id": vm, "max_cpu": cpu}) for s, vm, cpu in readings] + list(raw)
        rows = [{"value": t, "topic": "raw", "partition": 0, "offset": i, "timestamp": "2024-01-01 00:00:00"} for i, t in enumerate(texts)]
        file = f"{self.dir}/{self.sent:04d}.json"
        with open(file, "w") as handle:
            handle.write("\n".join(json.dumps(r) for r in rows))
        os.utime(file, (STAMP + self.sent, STAMP + self.sent))
        self.sent += 1

    def messages(self):
        schema = "value string, topic string, partition int, offset bigint, timestamp timestamp"
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(self.dir)

    def readings(self):
        return readings_from_messages(self.messages())


@pytest.fixture
def topic(spark, path):
    return Topic(spark, path)


def drain(df, path, **more):
    query = pipelines.run_silver(df, f"{path}/silver", f"{path}/check", bounded=True, **more)
    query.awaitTermination()
    return query


def stored(spark, path):
    rows = keyed.read_silver(spark, f"{path}/silver").collect()
    return {(r.vm_id, int((r.window_start - T0).total_seconds())): r.avg_max_cpu for r in rows}


def test_changed_windows_are_sent_again_and_the_last_one_stands(spark, topic, path):
    topic.send((0, "a", 93.0), (0, "b", 10.0))
    topic.send((60, "a", 10.0))
    drain(window_average(topic.readings()), path)
    assert keyed.read_versions(spark, f"{path}/silver").count() == 3
    assert stored(spark, path) == {("a", 0): 51.5, ("b", 0): 10.0}


def test_restart_goes_on_where_it_stopped(spark, topic, path):
    topic.send((0, "a", 10.0))
    drain(window_average(topic.readings()), path)
    topic.send((1, "a", 20.0), (200, "a", 5.0))
    query = drain(window_average(topic.readings()), path)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert stored(spark, path) == {("a", 0): 15.0, ("a", 180): 5.0}


def test_late_rows_drop_two_batches_after_the_jump(spark, topic, path):
    """Rows are judged by the watermark of the batch before."""
    topic.send((0, "a", 10.0))
    topic.send((1000, "a", 10.0))
    topic.send((5, "a", 30.0))
    topic.send((6, "a", 90.0))
    query = drain(window_average(topic.readings()), path)
    assert stored(spark, path)[("a", 0)] == 20.0
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 1


def test_stream_equals_batch_over_the_same_rows(spark, topic, path):
    rows = [(i * 37 % 2000, f"vm{i % 5}", float(i % 120)) for i in range(200)]
    for i in range(0, 200, 50):
        topic.send(*rows[i : i + 50], raw=["garbage", '{"vm_id": "x"}'])
    drain(window_average(topic.readings(), watermark="1 day"), path)
    batch = spark.createDataFrame([(f"vm{i % 5}", T0 + timedelta(seconds=s), c) for i, (s, _, c) in enumerate(rows)], "vm_id string, event_time timestamp, max_cpu double")
    want = {(r.vm_id, int((r.window_start - T0).total_seconds())): r.avg_max_cpu for r in window_average(batch).collect()}
    assert stored(spark, path) == pytest.approx(want)


def test_repeated_messages_count_once_when_asked(spark, topic, path):
    topic.send((0, "a", 90.0), (0, "a", 90.0))
    topic.send((0, "a", 90.0), (1, "a", 30.0))
    drain(window_average(topic.readings(), unique_readings=True), path)
    assert stored(spark, path) == {("a", 0): 60.0}


def test_large_state_in_rocksdb_gives_the_same(spark, topic, path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        topic.send((0, "a", 93.0))
        topic.send((60, "a", 10.0))
        drain(window_average(topic.readings()), path)
    finally:
        spark.conf.set(key, before)
    assert stored(spark, path) == {("a", 0): 51.5}


def test_table_and_topic_get_the_same_rows(spark, topic, path):
    topic.send((0, "a", 93.0))
    topic.send((1, "a", 99.0))
    drain(window_average(topic.readings()), path, topic=pipelines.stored_topic(f"{path}/out"))
    messages = spark.read.parquet(f"{path}/out")
    assert sorted(json.loads(bytes(r.value))["avg_max_cpu"] for r in messages.collect()) == [93.0, 96.0]
    assert {bytes(r.key) for r in messages.collect()} == {b"a"} and set(ENVELOPE.fieldNames()) <= set(messages.columns)


def test_failing_sink_fails_the_batch_and_loses_nothing(spark, topic, path):
    topic.send((0, "a", 93.0))

    def down(df, number):
        raise RuntimeError("store is down")

    with pytest.raises(StreamingQueryException, match="store is down"):
        drain(window_average(topic.readings()), path, topic=down)
    drain(window_average(topic.readings()), path)
    assert stored(spark, path) == {("a", 0): 93.0} and keyed.read_versions(spark, f"{path}/silver").count() == 1


def test_drifted_batch_is_refused(spark, topic, path):
    topic.send((0, "a", 1.0), raw=['{"vm": "renamed"}'])
    query = topic.readings().writeStream.foreachBatch(pipelines.guarded(lambda df, n: None, ["vm_id"]))
    with pytest.raises(StreamingQueryException, match="vm_id: 1 of 2 null"):
        query.option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start().awaitTermination()


def test_null_keys_do_not_reach_the_table(spark, topic, path):
    topic.send((0, "a", 1.0), raw=['{"timestamp": 0, "max_cpu": 5.0}'])
    drain(window_average(topic.readings()), path)
    assert stored(spark, path) == {("a", 0): 1.0}
    assert keyed.read_quarantine(spark, f"{path}/silver").first().avg_max_cpu == 5.0


def test_alerts_leave_with_their_batch(spark, topic, path):
    topic.send((0, "a", 95.0), (0, "b", 90.0))
    topic.send((1, "c", 99.0))
    pipelines.run_alerts(topic.readings(), f"{path}/alerts", f"{path}/check", bounded=True).awaitTermination()
    got = {(r.batch_id, json.loads(bytes(r.value))["vm_id"]) for r in spark.read.parquet(f"{path}/alerts").collect()}
    assert got == {(0, "a"), (1, "c")}


def test_critical_windows(spark, topic, path):
    topic.send((0, "a", 95.0), (1, "b", 95.0), (400, "a", 1.0))
    pipelines.run_critical(topic.readings(), f"{path}/critical", f"{path}/check", "3 minutes", 0.5, bounded=True).awaitTermination()
    rows = [json.loads(bytes(r.value)) for r in spark.read.parquet(f"{path}/critical").collect()]
    assert [(r["readings"], r["alerts"]) for r in rows] == [(2, 2)]


def test_bounded_run_then_batch(spark, topic, path):
    topic.send(*[(180 * i, "a", 95.0 if i < 4 else 1.0) for i in range(5)])
    pipelines.silver_then_gold(window_average(topic.readings()), f"{path}/silver", f"{path}/gold", f"{path}/check")
    row = keyed.read_gold(spark, f"{path}/gold").first()
    assert (row.overload_frequency, row.recommendation) == (0.8, "Upgrade to higher CPU capacity")
    assert row.processed_time is not None
    report = gold.report(keyed.read_gold(spark, f"{path}/gold")).first()
    assert report.overload_frequency == "80.00%"


def test_metrics_per_batch(spark, topic, path):
    topic.send((0, "a", 95.0), (1, "a", 1.0))
    topic.send((500, "a", 1.0))
    listener = MetricsListener(spark, f"{path}/metrics")
    spark.streams.addListener(listener)
    try:
        drain(window_average(observed(topic.readings(), is_over(F.col("max_cpu")))), path, name="watched")
        deadline = datetime.now() + timedelta(seconds=20)
        while listener.last_batch is None or listener.last_batch < 1:
            assert datetime.now() < deadline
    finally:
        spark.streams.removeListener(listener)
    rows = {r.batch_id: r for r in read_metrics(spark, f"{path}/metrics").collect() if r.input_rows}
    assert (rows[0].input_rows, rows[0].observed_rows, rows[0].error_percent) == (2, 2, 50.0)
    assert rows[1].error_rows == 0 and rows[1].latency_ms > 0 and rows[1].query_name == "watched"
    assert rows[1].watermark_delay_sec is not None


def test_several_queries_run_side_by_side(spark, topic, path):
    spark.streams.resetTerminated()
    topic.send((0, "a", 95.0))
    silver = pipelines.run_silver(window_average(topic.readings()), f"{path}/s", f"{path}/c1")
    alerts = pipelines.run_alerts(topic.readings(), f"{path}/a", f"{path}/c2")
    shown = console(topic.readings().select("vm_id"))
    try:
        for query in (silver, alerts, shown):
            query.processAllAvailable()
        alerts.stop()
        pipelines.wait_for_any(spark)
        assert len(spark.streams.active) == 2
    finally:
        for query in (silver, shown):
            query.stop()
        spark.streams.resetTerminated()
    assert keyed.read_silver(spark, f"{path}/s").count() == 1 and TRACE_START == 1546300800
