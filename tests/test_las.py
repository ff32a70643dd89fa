import os
import struct
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeloft.operators.points import CORE_DIMENSIONS, EXPORT_DIMENSIONS, chunk, stored_points, unchunk
from gaugeloft.plans.staging import las_bytes
from gaugeloft.sinks import keyed
from gaugeloft.sinks.files import export_points_csv
from gaugeloft.sources import las, las_records
from gaugeloft.sources.runlogs import read_run_logs
from gaugeloft.sources.topics import chunk_messages, completion_messages, read_topic
from gaugeloft.streaming import pipelines
from gaugeloft.streaming.pipelines import run_las


def cloud(count, point_format=1, **more):
    at = np.arange(count)
    columns = {"X": at * 2, "Y": -at, "Z": at % 7, "intensity": at % 100, "point_source_id": at % 5, **more}
    if point_format < 6:
        columns.setdefault("_returns", np.full(count, 0b11_010_001, dtype=np.uint8))
        columns.setdefault("_class", np.full(count, 0b101_00010, dtype=np.uint8))
    return las_bytes(point_format, columns)


def put(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as handle:
        handle.write(data)
    return f"{folder}/{name}"


def test_dimensions_and_values(spark, path):
    file = put(f"{path}/tenantB", "a.b.las", cloud(10))
    df = las.read_las(spark, file)
    assert df.columns == [*las.PLACES, *las_records.all_dimensions(), *las_records.SCALED]
    assert {c for c in df.columns if df.filter(F.col(c).isNotNull()).count()} == {
        "tenant_id", "file_name", "point_index", "point_format_id", "X", "Y", "Z", "intensity", "return_number",
        "number_of_returns", "scan_direction_flag", "edge_of_flight_line", "classification", "synthetic", "key_point",
        "withheld", "scan_angle_rank", "user_data", "point_source_id", "gps_time", "scaled_x", "scaled_y", "scaled_z",
    }
    row = df.filter("point_index = 3").first()
    assert (row.tenant_id, row.file_name, row.X, row.Y, row.scaled_x, row.scaled_y) == ("tenantB", "a.b.las", 6, -3, 103.0, 198.5)
    assert (row.return_number, row.number_of_returns, row.scan_direction_flag, row.edge_of_flight_line) == (1, 2, 1, 1)
    assert (row.classification, row.synthetic, row.key_point, row.withheld) == (2, 1, 0, 1)


@pytest.mark.parametrize("point_format", range(11))
def test_all_point_formats(spark, path, point_format):
    extra = {n: np.full(4, 9) for n, _ in las_records.RECORDS[point_format] if n in ("red", "nir", "gps_time", "wavepacket_offset", "x_t")}
    file = put(path, "f.las", cloud(4, point_format, **extra))
    rows = las.read_las(spark, file).collect()
    assert [(r.X, r.point_format_id) for r in rows] == [(2 * i, point_format) for i in range(4)]
    assert all(r[name] == 9 for r in rows for name in extra)


@pytest.mark.parametrize("split", [1, 100, 227, 301, 5000])
def test_ranges_share_no_point_and_leave_none_out(spark, path, split):
    put(path, "f.las", cloud(60))
    df = las.read_las(spark, path, ["point_index", "X"], split_bytes=split)
    assert sorted((r.point_index, r.X) for r in df.collect()) == [(i, 2 * i) for i in range(60)]


@pytest.mark.parametrize("split,size", [(300, 7), (1000, 7), (1 << 20, 7), (500, 100)])
def test_chunks_without_a_shuffle_equal_grouped_chunks(spark, path, split, size):
    put(f"{path}/tenantC", "f.las", cloud(60))
    files = las.list_las(spark, path, recursive=True)
    direct = las.chunks_of(files, size, split_bytes=split)
    grouped = chunk(las.points_of(files, split_bytes=split).drop("point_format_id", "file_id"), ["tenant_id", "file_name"], "point_index", size)
    assert sorted(direct.collect(), key=lambda r: r.chunk_number) == sorted(grouped.select(direct.columns).collect(), key=lambda r: r.chunk_number)
    assert sorted(stored_points(unchunk(direct)).collect()) == sorted(stored_points(unchunk(grouped)).collect())


def test_empty_truncated_and_padded_files(spark, path):
    put(path, "empty.las", cloud(0))
    put(path, "cut.LAS", cloud(10)[:-30])
    longer = bytearray(cloud(3, 0))
    body, longer = bytes(longer[227:]), longer[:227]
    struct.pack_into("<H", longer, 105, 25)
    put(path, "extra.las", bytes(longer) + b"".join(body[i * 20 : i * 20 + 20] + b"extra" for i in range(3)))
    put(path, "note.txt", b"no points")
    got = {r.file_name: r["count"] for r in las.read_las(spark, path, ["file_name", "X"]).groupBy("file_name").count().collect()}
    assert got == {"cut.LAS": 8, "extra.las": 3}
    assert [r.X for r in las.read_las(spark, f"{path}/extra.las").collect()] == [0, 2, 4]


def test_large_point_counts_of_version_1_4(path):
    header = bytearray(375)
    header[:4], header[24:26] = b"LASF", bytes([1, 4])
    struct.pack_into("<HIIBHI", header, 94, 375, 375, 0, 6, 30, 0)
    struct.pack_into("<Q", header, 247, 5_000_000_000)
    assert las_records.parse_header(bytes(header), 375 + 30 * 6_000_000_000).points == 5_000_000_000


@pytest.mark.parametrize("damage,message", [(lambda d: b"nope" + d[4:], "not a LAS file"), (lambda d: d[:104] + bytes([129]) + d[105:], "LAZ")])
def test_other_files_are_refused(spark, path, damage, message):
    file = put(path, "f.las", damage(cloud(5)))
    with pytest.raises(PySparkException, match=message):
        las.read_las(spark, file).count()


def test_mixed_formats(spark, path):
    put(path, "a.las", cloud(2, 0))
    put(path, "b.las", cloud(2, 3, red=np.full(2, 7)))
    put(path, "c.las", cloud(2, 1, gps_time=np.full(2, 1.5)))
    rows = las.read_las(spark, path).orderBy("file_name").collect()
    assert [(r.file_name, r.red, r.gps_time) for r in rows] == [("a.las", None, None)] * 2 + [("b.las", 7, 0.0)] * 2 + [("c.las", None, 1.5)] * 2
    export_points_csv(las.read_las(spark, path), f"{path}/out")
    assert spark.read.option("header", True).csv(f"{path}/out").filter("gps_time = 1.5").count() == 2


def test_file_filters_skip_files(spark, path):
    put(f"{path}/tenantA", "a.las", cloud(3))
    # Would fail if it were opened.
    put(f"{path}/tenantB", "b.las", b"broken")
    df = las.read_las(spark, path, ["tenant_id", "file_name", "X"], recursive=True)
    assert df.filter("tenant_id = 'tenantA' AND X >= 2").count() == 2
    assert df.filter(F.col("file_name").isin("a.las", "c.las")).count() == 3


def test_position_bounds_stop_the_read(spark, path):
    put(path, "f.las", cloud(60))
    df = las.read_las(spark, path, ["point_index", "X"], split_bytes=500)
    assert df.filter("point_index < 7").count() == 7 and df.filter("point_index <= 7 AND point_index < 20").count() == 8
    assert df.filter("point_index <= 7 AND point_index >= 5 AND X > 10").count() == 2
    assert df.filter("point_index < 0").count() == 0
    reader = las.PruningLasReader(df.schema, [path], False, 500)
    assert list(reader.pushFilters([las.LessThanOrEqual(("point_index",), 7), las.EqualTo(("X",), 1)])) == [las.EqualTo(("X",), 1)]
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 8


def test_description(spark, path):
    file = put(path, "f.las", cloud(9, 2))
    rows = las.describe_las(spark, file, sample=1).collect()
    assert {r.point_format_id for r in rows} == {2} and [r.dimension for r in sorted(rows, key=lambda r: r.place)][-3:] == ["red", "green", "blue"]


def test_export_has_all_columns_and_empty_gaps(spark, path):
    file = put(path, "f.las", cloud(25, 0))
    export_points_csv(las.read_las(spark, file), f"{path}/out", wanted=11, size=10)
    rows = spark.read.option("header", True).csv(f"{path}/out")
    assert rows.columns == EXPORT_DIMENSIONS and rows.count() == 20
    assert rows.filter("gps_time IS NULL AND X IS NOT NULL").count() == 20


def test_arriving_files_are_taken_once(spark, path):
    for tenant in "AB":
        put(f"{path}/in/tenant{tenant}", "one.las", cloud(5))
    put(f"{path}/in/tenantA", "skip.txt", b"x")

    def drain():
        files = las.watch_las(spark, [f"{path}/in/tenantA", f"{path}/in/tenantB"])
        run_las(files, f"{path}/points", f"{path}/check", bounded=True).awaitTermination()

    drain()
    put(f"{path}/in/tenantB", "two.LAS", cloud(7))
    drain()
    drain()
    assert keyed.read_versions(spark, f"{path}/points").count() == 17
    stored = keyed.read_points(spark, f"{path}/points").groupBy("tenant_id", "file_name").count()
    assert sorted(map(tuple, stored.collect())) == [("tenantA", "one.las", 5), ("tenantB", "one.las", 5), ("tenantB", "two.LAS", 7)]


def test_published_files(spark, path):
    """Chunks of one file go out, then are consumed: points, stats and logs agree."""
    put(f"{path}/in/tenantA", "one.las", cloud(25))
    put(f"{path}/in/tenantA", "none.las", cloud(0))
    topics = {name: pipelines.stored_topic(f"{path}/{name}", name, "tenant_id") for name in ("raw-data", "raw-data-metadata")}
    files = las.watch_las(spark, f"{path}/in/tenantA")
    pipelines.run_las_topics(files, *topics.values(), f"{path}/log", f"{path}/c", chunk_points=10, bounded=True).awaitTermination()
    logged = {r.file_name: (r.records_processed, r.status) for r in read_run_logs(spark, f"{path}/log").collect()}
    assert logged == {"one.las": (25, "success"), "none.las": (0, "error")}

    chunks, completions = (read_topic(spark, n, "parquet", f"{path}/{n}", stream=True) for n in topics)
    running = pipelines.run_chunk_topics(
        chunk_messages(chunks)[0], completion_messages(completions)[0], f"{path}/points", f"{path}/stats", f"{path}/c2", True, f"{path}/log2"
    )
    for query in running:
        query.awaitTermination()
    stats = {r.file_name: r.records_processed for r in keyed.read_file_stats(spark, f"{path}/stats").collect()}
    assert stats == {"one.las": 25, "none.las": 0}
    points = keyed.read_points(spark, f"{path}/points")
    assert points.count() == 25 and points.agg(F.sum("x")).first()[0] == sum(2 * i for i in range(25))
    assert sorted(r.points_processed for r in read_run_logs(spark, f"{path}/log2/consumer", "consumer").collect()) == [5, 10, 10]
    assert read_run_logs(spark, f"{path}/log2/completed", "completed").count() == 2


def test_small_rows_for_much_work_are_not_packed_into_one_task(spark, path):
    for i in range(5):
        put(path, f"{i}.las", cloud(100))
    files = las.list_las(spark, path)
    sizes = las.points_of(files, split_bytes=1500).select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert sizes.count() == 10
    assert las.file_totals_of(files).agg(F.sum("total_points")).first()[0] == 500


def test_package_reaches_workers_outside_the_repository(path):
    """The Python workers of a program started elsewhere cannot import the package by themselves."""
    put(f"{path}/data", "f.las", cloud(9))
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from gaugeloft.session import build_session
from gaugeloft.sources.las import list_las, points_of, read_las
spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {path!r}}})
print("points", read_las(spark, {path + "/data"!r}).count() + points_of(list_las(spark, {path + "/data"!r})).count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=path, capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "points 18" in done.stdout, done.stderr[-2000:]


def test_labels_agree_with_the_column_functions(spark):
    from gaugeloft.functions.naming import file_name_of, tenant_of

    paths = ["/x/tenantQ/f.las", "/x/f.las", "tenant/tenant2/g", "hdfs://host/data/tenantZ/h.las"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", tenant_of(F.col("p")).alias("t"), file_name_of(F.col("p")).alias("f"))
    assert all(las.labels_of(r.p) == {"tenant_id": r.t, "file_name": r.f} for r in df.collect())
    assert set(CORE_DIMENSIONS) <= set(las_records.all_dimensions())


def test_many_small_files_share_partitions_and_keep_their_names(spark, path):
    ranges = [(f"hdfs://nn:8020/t/{i}.las", 0, 300_000) for i in range(10_000)]
    parts = las.packed(ranges, las.SPLIT_BYTES, las.OPEN_COST)
    assert [r for p in parts for r in p.ranges] == ranges
    assert len(parts) <= 10_000 * (300_000 + las.OPEN_COST) / las.SPLIT_BYTES + 20
    assert len(las.packed([("a", 0, 10), ("a", 10, 20)], 10, 10)) == 2
    for i in range(30):
        put(f"{path}/tenantA", f"{i}.las", cloud(10))
    df = las.read_las(spark, path, ["file_name", "X"], recursive=True)
    assert df.rdd.getNumPartitions() == 1 and df.select("file_name").distinct().count() == 30


def test_paths_of_other_file_systems(spark, path, monkeypatch):
    from gaugeloft import storage
    from gaugeloft.session import qualified

    assert {storage.filesystem_of(p)[1] for p in ("file:/a/b", "file:///a/b", "/a/b")} == {"/a/b"}
    with pytest.raises(ValueError, match="no file system"):
        storage.filesystem_of("dbfs:/x")
    system, local = storage.filesystem_of("s3a://bucket/key?region=eu-west-1")
    assert system.type_name == "s3" and local == "bucket/key"
    assert qualified(spark, "/a/b") == "file:/a/b"


def test_bad_files_do_not_stop_the_others(spark, path):
    for i in range(3):
        put(f"{path}/in/tenantA", f"good{i}.las", cloud(25))
    put(f"{path}/in/tenantA", "junk.las", b"junk")
    put(f"{path}/in/tenantA", "nothing.las", b"LASF")
    put(f"{path}/in/tenantB", "cut.las", cloud(10)[:-30])
    topics = {name: pipelines.stored_topic(f"{path}/{name}", name, "tenant_id") for name in ("raw-data", "raw-data-metadata")}
    pipelines.run_las_topics(las.watch_las(spark, f"{path}/in/*"), *topics.values(), f"{path}/log", f"{path}/c", chunk_points=10, bounded=True).awaitTermination()
    logged = {r.file_name: (r.records_processed, r.status, bool(r.errors)) for r in read_run_logs(spark, f"{path}/log").collect()}
    assert logged == {**{f"good{i}.las": (25, "success", False) for i in range(3)}, "junk.las": (0, "error", True), "nothing.las": (0, "error", True), "cut.las": (8, "success", True)}
    told = completion_messages(read_topic(spark, "raw-data-metadata", "parquet", f"{path}/raw-data-metadata"))[0]
    assert sorted(r.file_name for r in told.collect()) == ["cut.las", "good0.las", "good1.las", "good2.las"]
    run_las(las.watch_las(spark, f"{path}/in/*"), f"{path}/points", f"{path}/c2", bounded=True, log_path=f"{path}/log2").awaitTermination()
    assert keyed.read_points(spark, f"{path}/points").count() == 83
    assert {r.file_name for r in read_run_logs(spark, f"{path}/log2").collect()} == {"junk.las", "nothing.las", "cut.las"}


def test_seconds_are_those_of_the_file(spark, path):
    for i in range(50):
        put(f"{path}/in/tenantA", f"{i}.las", cloud(50))
    topics = {name: pipelines.stored_topic(f"{path}/{name}", name, "tenant_id") for name in ("raw-data", "raw-data-metadata")}
    begin = time.monotonic()
    pipelines.run_las_topics(las.watch_las(spark, f"{path}/in/tenantA"), *topics.values(), f"{path}/log", f"{path}/c", bounded=True).awaitTermination()
    batch = time.monotonic() - begin
    seconds = [r.ingestion_time_sec for r in read_run_logs(spark, f"{path}/log").collect()]
    assert len(seconds) == 50 and all(0 < s < batch / 2 for s in seconds)
