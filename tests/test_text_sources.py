import csv
import gzip
import io
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gaugeloft.functions.convert import to_message
from gaugeloft.operators import faults, runs
from gaugeloft.operators.gold import silver_from_messages
from gaugeloft.schemas import CHUNK_MESSAGE, COMPLETION_MESSAGE
from gaugeloft.sinks.files import append_run_log
from gaugeloft.sinks.messages import fan_out, write_messages
from gaugeloft.sources import readings, topics
from gaugeloft.sources.runlogs import read_run_logs

LINES = [
    "0,vm/1+a==,1.5,99.5,22.63",
    "12.9,vm2,x,2,3",
    "5,vm3,1,2",
    "",
    "7,vm4,1,2,3,extra",
    "8,vm5,1,2,",
    "9,vm6,1,2,,more",
    '10,"a,b",1,2,3',
    '11,"say ""hi""",1,2,3',
    "12,vm7,,NaN,3",
    '13,"a,b",1,2',
]


def reference(lines):
    """What a plain CSV reader with the conversion rule gives."""
    kinds = [("long", 0), ("string", ""), ("double", 0.0), ("double", 0.0), ("double", 0.0)]
    rows, invalid = [], 0
    for fields in csv.reader(io.StringIO("\n".join(lines) + "\n")):
        if len(fields) < 5:
            invalid += 1
            continue
        row = []
        for text, (kind, default) in zip(fields, kinds):
            try:
                row.append(int(float(text)) if kind == "long" else float(text) if kind == "double" else text)
            except ValueError:
                row.append(default)
        rows.append(tuple(row))
    return rows, invalid


@pytest.fixture
def tenants(path):
    os.makedirs(f"{path}/tenantA"), os.makedirs(f"{path}/tenantB")
    with open(f"{path}/tenantA/a.csv", "w") as handle:
        handle.write("\n".join(LINES) + "\n")
    with gzip.open(f"{path}/tenantB/b.csv.gz", "wt") as handle:
        handle.write("1,z,1,2,3\n")
    with open(f"{path}/tenantB/notes.txt", "w") as handle:
        handle.write("2,not,1,2,3\n")
    return [f"{path}/tenantA", f"{path}/tenantB"]


def test_csv_follows_a_plain_reader(spark, tenants):
    df = readings.read_readings_csv(spark, tenants)
    want, _ = reference(LINES)
    mine = [tuple(r)[1:] for r in df.filter("tenant_id = 'tenantA'").collect()]
    assert sorted(map(str, mine)) == sorted(map(str, want))
    assert [tuple(r) for r in df.filter("tenant_id = 'tenantB'").collect()] == [("tenantB", 1, "z", 1.0, 2.0, 3.0)]


def test_counters(spark, tenants):
    lines = readings.scan_lines(spark, tenants)
    row = runs.ingest_counters(lines.filter("tenant_id = 'tenantA'"), ["tenant_id"]).first()
    want, invalid = reference(LINES)
    assert (row.lines, row["valid"], row.invalid, row.filtered, row.sent) == (len(LINES), len(want), invalid, 0, len(want))
    sampled = runs.ingest_counters(readings.scan_lines(spark, tenants, modulus=3), ["tenant_id"]).collect()
    assert all(r.lines == r["valid"] + r.invalid + r.filtered for r in sampled) and sum(r.filtered for r in sampled) > 0


def test_quarantine_mode(spark, tenants):
    lines = readings.scan_lines(spark, tenants)
    kept = readings.typed_readings(lines, on_error="quarantine")
    rejected = readings.rejected_lines(lines)
    assert kept.count() + rejected.count() == len(LINES) + 1
    reasons = {r.value: r.reason for r in rejected.collect()}
    assert reasons["5,vm3,1,2"] == "too few fields" and reasons["12.9,vm2,x,2,3"] == "bad min_cpu"


@pytest.mark.parametrize("percent", [5, 10, 20])
def test_faulty_lines_do_not_change_the_others(spark, percent):
    clean = spark.range(3000).select("id", F.concat_ws(",", "id", F.lit("vm"), "id", "id", "id").alias("line"))
    damaged = clean.select(faults.damage(F.col("line"), F.col("id"), percent).alias("value"), F.lit("p").alias("path"))
    got = readings.typed_readings(readings.mark_lines(damaged), on_error="quarantine")
    bad = clean.filter(faults.is_faulty(F.col("id"), percent)).count()
    assert 0.5 * percent < bad / 30 < 1.5 * percent
    good = {r.id for r in clean.filter(~faults.is_faulty(F.col("id"), percent)).collect()}
    assert good <= {r.timestamp for r in got.collect()}


def envelope(spark, texts, topic="raw-data"):
    rows = [(json.dumps(t) if not isinstance(t, str) else t,) for t in texts]
    df = spark.createDataFrame(rows, "value string").coalesce(1)
    return topics.as_envelope(df.select(F.lit("k").alias("key"), "value"), topic)


CHUNK = {"tenant_id": "t", "file_name": "f", "chunk_number": 0, "points": [{"X": 1, "classification": 2}], "timestamp": 1.5}
DONE = {"tenant_id": "t", "file_name": "f", "status": "completed", "total_points": 1}


def test_messages_are_routed_by_their_fields(spark):
    chunks, others = topics.chunk_messages(envelope(spark, [CHUNK, DONE, "garbage", {**CHUNK, "points": None}]))
    assert (chunks.count(), others.count()) == (1, 3)
    assert chunks.first().points[0].scan_angle_rank is None
    done, rest = topics.completion_messages(envelope(spark, [DONE, CHUNK]))
    assert (done.first().total_points, rest.count()) == (1, 1)


def test_peek(spark):
    both = envelope(spark, [CHUNK, {**CHUNK, "chunk_number": 9}]).unionByName(envelope(spark, [{**CHUNK, "points": []}], "empty"))
    rows = {r.topic: r for r in topics.peek_chunks(both).collect()}
    assert (rows["raw-data"].chunk_number, rows["raw-data"].point_count, rows["raw-data"].first_point.X) == (0, 1, 1.0)
    assert (rows["empty"].point_count, rows["empty"].first_point) == (0, None)
    assert topics.peek_completions(envelope(spark, [DONE], "meta")).first().status == "completed"
    assert len(CHUNK_MESSAGE) == 5 and len(COMPLETION_MESSAGE) == 7


def test_stored_topics_and_replay(spark, path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "vm_id string, n int")
    topics.store_messages(to_message(df, "vm_id"), "one", path, 0)
    topics.store_messages(to_message(df, "vm_id"), "one", path, 0)
    topics.store_messages(to_message(df.limit(1), "vm_id"), "two", path, 1)
    stored = topics.read_topic(spark, "one", "parquet", path)
    assert sorted((bytes(r.key).decode(), bytes(r.value).decode()) for r in stored.collect()) == [("a", '{"vm_id":"a","n":1}'), ("b", '{"vm_id":"b"}')]
    assert topics.replay(spark.read.parquet(path), "two").count() == 1
    assert to_message(df, "n").schema["key"].dataType == StringType()


def test_fan_out_computes_once_and_raises(spark):
    seen = spark.sparkContext.accumulator(0)

    def count_rows(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(10).mapInPandas(count_rows, "id long")
    stored = []
    fan_out(df, [lambda d: stored.append(d.count()), lambda d: stored.append(d.agg(F.sum("id")).first()[0])])
    assert stored == [10, 45] and seen.value == 10

    def broken(_):
        raise RuntimeError("store is down")

    with pytest.raises(RuntimeError):
        fan_out(df, [broken])


def test_later_batches_of_a_topic_win(spark, path):
    for batch, average in enumerate([93.0, 65.0]):
        rows = spark.createDataFrame([("a", "2019-01-01 00:00:00", "2019-01-01 00:03:00", average, average > 90)], "vm_id string, window_start string, window_end string, avg_max_cpu double, is_window_anomaly boolean")
        topics.store_messages(to_message(rows, "vm_id"), "silver", path, batch)
    stored = topics.read_topic(spark, "silver", "parquet", path)
    assert [r.avg_max_cpu for r in silver_from_messages(stored).collect()] == [65.0]
    assert silver_from_messages(stored, dedup=False).count() == 2
    first = topics.first_messages(stored).first()
    assert json.loads(bytes(first.value))["avg_max_cpu"] == 93.0


def test_broker_options_are_passed_on(spark):
    """There is no connector here, so Spark names the missing source."""
    with pytest.raises(AnalysisException, match="kafka"):
        topics.read_topic(spark, "t", **{"kafka.bootstrap.servers": "host:1"})
    with pytest.raises(AnalysisException, match="kafka"):
        write_messages(spark.range(1).toDF("vm_id"), "t", **{"kafka.bootstrap.servers": "host:1"})


def test_run_logs_round_trip(spark, path):
    rows = spark.createDataFrame([("tenantA", "f", 30.0, 16.83, 550000), ("tenantB", "g", 30.0, 0.0, 0)], "tenant_id string, file_name string, file_size_mb double, ingestion_time_sec double, records_processed bigint")
    record = runs.ingestion_record(rows, F.lit("2025-03-13 12:42:56").cast("timestamp"))
    append_run_log(record, path)
    append_run_log(record, path)
    got = read_run_logs(spark, path).distinct().orderBy("tenant_id").collect()
    assert [(r.tenant_id, r.timestamp, r.throughput_mb_sec, r.status, r.errors) for r in got] == [
        ("tenantA", "2025-03-13T12:42:56Z", 1.78, "success", []),
        ("tenantB", "2025-03-13T12:42:56Z", 0.0, "error", []),
    ]
    assert read_run_logs(spark, path).count() == 4


def test_run_logs_with_gaps(spark, path):
    with open(f"{path}/tenantA_ingestion_log.json", "w") as handle:
        handle.write('{"tenant_id": "tenantA", "records_processed": 5, "status": "success"}\n')
        handle.write('{"tenant_id": "tenantA", "throughput_mb_sec": 2.0, "status": "error", "errors": ["bad 12", "bad 7"]}\n')
    logs = read_run_logs(spark, path, glob="*_ingestion_log.json")
    stats = runs.run_statistics(logs).first()
    assert (stats.runs, stats.mean_throughput, stats.mean_good_throughput, stats.success_rate) == (2, 2.0, None, 0.5)
    patterns = {r.pattern: r.occurrences for r in runs.failure_patterns(logs).collect()}
    assert patterns == {"bad #": 2, None: 1}
    alert = runs.run_alerts(runs.run_statistics(logs), min_throughput=3.0, max_error_rate=0.4, max_seconds=1.0).first()
    assert alert.reasons == ["throughput", "error rate"]
    assert runs.run_alerts(runs.run_statistics(logs)).count() == 0


def test_completed_and_chunk_records(spark):
    done = spark.createDataFrame([("t", "f", "completed", 10, 1, 30.0, 15.0), ("t", "g", "failed", 1, 1, 1.0, 1.0)], "tenant_id string, file_name string, status string, total_points bigint, total_chunks bigint, file_size_mb double, processing_time_sec double")
    at = F.lit("2025-03-13 12:42:56").cast("timestamp")
    assert [(r.file_name, r.throughput_mb_sec) for r in runs.completed_record(done, at).collect()] == [("f", 2.0)]
    chunks = spark.createDataFrame([("t", "f", 3, [(1.0,)] * 100)], "tenant_id string, file_name string, chunk_number int, points array<struct<X double>>")
    row = runs.chunk_record(chunks, at, F.lit(0.01)).first()
    assert (row.points_processed, row.throughput_mb_sec) == (100, round(100 * 192 / 1048576 / 0.01, 2))


def test_throughput_grid(spark):
    logs = spark.createDataFrame([(1, 1, 1.8), (1, 1, 1.9), (3, 4, 0.69)], "tenants int, files int, throughput_mb_sec double")
    got = {r.tenants: (r["1"], r["2"], r["4"]) for r in runs.throughput_grid(logs, "tenants", "files", [1, 2, 4], 2).collect()}
    assert got == {1: (1.85, None, None), 3: (None, None, 0.69)}
