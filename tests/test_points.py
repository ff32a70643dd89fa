import math
import random
import uuid

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeloft.operators import points
from gaugeloft.operators.latest import latest
from gaugeloft.operators.joins import fits_broadcast, join_small
from gaugeloft.operators.points import stored_points, unchunk
from gaugeloft.operators.ranks import dense_position, exact_percentiles
from gaugeloft.sinks import keyed
from gaugeloft.sources.topics import chunk_messages


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 30), min_size=1, max_size=3), size=st.integers(1, 12))
def test_chunk_then_unchunk_is_the_identity(spark, sizes, size):
    rows = [(f"f{i}", p, i * 100 + p) for i, n in enumerate(sizes) for p in range(n)]
    random.Random(0).shuffle(rows)
    chunks = points.chunk(spark.createDataFrame(rows, "file_name string, at bigint, X int"), ["file_name"], "at", size)
    got = chunks.select("file_name", "chunk_number", F.size("points").alias("n")).collect()
    for i, n in enumerate(sizes):
        mine = sorted((r.chunk_number, r.n) for r in got if r.file_name == f"f{i}")
        assert mine == [(c, min(size, n - c * size)) for c in range(math.ceil(n / size))]
    flat = points.unchunk(chunks)
    back = flat.select("file_name", (F.col("chunk_number") * size + F.col("point_position")).alias("at"), "X")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert {r.file_name: (r.total_points, r.total_chunks) for r in points.file_totals(chunks, ["file_name"]).collect()} == {
        f"f{i}": (n, math.ceil(n / size)) for i, n in enumerate(sizes)
    }


def test_stored_points_fill_and_ids(spark):
    schema = "tenant_id string, file_name string, chunk_number int, points array<struct<X double, classification int, intensity double>>"
    chunks = spark.createDataFrame([("t", "f", 2, [(1.5, None, 7.0), (None, 3, None)]), ("t", "g", 0, None)], schema)
    rows = sorted(points.stored_points(points.unchunk(chunks)).collect(), key=lambda r: -r.x)
    file = str(uuid.uuid5(uuid.NAMESPACE_DNS, "t:f"))
    assert [(r.x, r.y, r.intensity, r.classification, r.scan_angle_rank) for r in rows] == [(1.5, 0.0, 7.0, 0, 0), (0.0, 0.0, 0.0, 3, 0)]
    assert [r.point_id for r in rows] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{file}:2:{i}")) for i in range(2)]


def test_numbered_points_get_the_ids_of_their_chunks(spark):
    flat = spark.range(25).select(F.lit("t").alias("tenant_id"), F.lit("f").alias("file_name"), F.col("id").alias("point_index"), F.col("id").alias("X"))
    direct = points.stored_points(points.in_chunks(flat, size=10))
    through = points.stored_points(points.unchunk(points.chunk(flat, ["tenant_id", "file_name"], "point_index", 10)))
    assert sorted(direct.collect()) == sorted(through.collect())


def test_file_stats_take_completed_files_only(spark):
    df = spark.createDataFrame([("t", "f", "completed", 5, 1, None, 0.0), ("t", "g", "failed", 5, 1, 1.0, 1.0)], "tenant_id string, file_name string, status string, total_points bigint, total_chunks bigint, file_size_mb double, processing_time_sec double")
    assert [(r.file_name, r.file_size_mb, r.records_processed) for r in points.file_stats(df).collect()] == [("f", 0.0, 5)]


def test_measurements_are_two_rows_per_point_in_32_bits(spark):
    df = spark.createDataFrame([("l", 0.1, 1.1, 2.2)], "lidar_id string, z double, x double, y double")
    got = sorted(map(tuple, points.long_measurements(df).collect()), key=lambda r: r[2])
    depth = float(np.float32(0.1))
    assert got == [("l", depth, "x", float(np.float32(1.1))), ("l", depth, "y", float(np.float32(2.2)))]


@pytest.mark.parametrize("wanted,kept", [(None, 25), (1, 10), (10, 10), (11, 20), (500, 25)])
def test_first_points_round_up_to_whole_chunks(spark, wanted, kept):
    assert points.first_points(spark.range(25).toDF("at"), wanted, "at", 10).count() == kept


def test_core_points_leave_out_what_a_file_lacks(spark):
    df = spark.range(1).select(F.lit(1).alias("X"), F.lit(2).alias("gps_time"), F.lit(3).alias("Z"))
    assert points.core_points(df, []).columns == ["X", "Z"]
    assert points.export_columns(df).columns == points.EXPORT_DIMENSIONS


def skewed(rows=4000, seed=1):
    rng = random.Random(seed)
    return [("hot" if i % 3 else rng.choice("abc"), rng.randint(0, 400), i) for i in range(rows)]


def test_positions_in_a_hot_group_spread_over_partitions(spark, many_partitions):
    rows = skewed() + [(None, 3, 10_000), (None, 1, 10_001)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = dense_position(df, ["g"], ["v", "i"]).collect()
    for group in {r[0] for r in rows}:
        want = sorted((v, i) for g, v, i in rows if g == group)
        mine = sorted((r.position, r.v, r.i) for r in got if r.g == group)
        assert [m[0] for m in mine] == list(range(len(want))) and [m[1:] for m in mine] == want


def test_positions_without_a_group(spark, many_partitions):
    got = dense_position(spark.range(100).repartition(5), [], ["id"]).collect()
    assert all(r.id == r.position for r in got) and len(got) == 100


def test_latest_measurements_equal_reducing_the_long_rows(spark):
    df = spark.createDataFrame([("l", float(i % 7), float(i), float(-i), i) for i in range(50)], "lidar_id string, z double, x double, y double, at int")
    long = latest(points.long_measurements(df, ["at"]), ["lidar_id", "depth", "measurement_type"], ["at"]).drop("at")
    assert sorted(points.latest_measurements(df, ["at"]).collect()) == sorted(long.collect())


@pytest.fixture
def many_partitions(spark):
    """Keeps small shuffles from being packed into one task, as large ones would not be either."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_percentiles_equal_linear_interpolation(spark, many_partitions):
    rows = skewed()
    df = spark.createDataFrame([(g, float(v)) for g, v, _ in rows] + [("a", None), ("a", float("nan"))], "g string, v double")
    wanted = {"lo": 0.01, "mid": 0.5, "hi": 0.99, "top": 1.0, "low": 0.0}
    for r in exact_percentiles(df, ["g"], "v", wanted).collect():
        mine = [v for g, v, _ in rows if g == r.g]
        assert [r[n] for n in wanted] == pytest.approx([float(np.quantile(mine, f)) for f in wanted.values()])


def test_join_small_beyond_the_broadcast_limit(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, v int")
    side = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    small = sorted(map(tuple, join_small(df, side, ["k"], "left").collect()), key=lambda r: r[1])
    assert small == [("a", 1, 10), (None, 2, 20), ("z", 3, None)] and fits_broadcast(side)
    monkeypatch.setattr("gaugeloft.operators.joins.MAX_BROADCAST_ROWS", 1)
    assert not fits_broadcast(side)
    large = sorted(map(tuple, join_small(df, side, ["k"], "left").collect()), key=lambda r: r[1])
    assert large == small


def test_points_are_spread_before_they_get_ids(spark, path):
    points = [{"X": 1.0, "Y": None, "Z": 2.0}] * 3
    chunks = spark.createDataFrame(
        [("A", "a.las", 0, points), ("A", "a.las", 1, points[:1]), ("007", "b.las", 0, points[:2])],
        "tenant_id string, file_name string, chunk_number int, points array<struct<X: double, Y: double, Z: double>>",
    )
    stored, write = [], keyed.upsert_points
    keyed.upsert_points = lambda df, *rest, **options: (stored.append((df, options)), write(df, *rest, **options))
    try:
        for batch in (0, 1):
            keyed.upsert_chunks(chunks, path, batch)
    finally:
        keyed.upsert_points = write
    for df, options in stored:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not options["rebalance"] and "RebalancePartitions" in plan
        assert "point_id" not in plan[plan.index("RebalancePartitions") :]
    found = keyed.read_points(spark, path).orderBy("tenant_id", "point_id").collect()
    want = stored_points(unchunk(chunks), []).orderBy("tenant_id", "point_id").collect()
    assert [r.asDict() for r in found] == [r.asDict() for r in want] and len(found) == 6


def test_a_message_is_parsed_once(spark):
    messages = spark.createDataFrame([(b'{"points": [{"X": 1.0}]}', 0), (b'{"points": [', 1), (None, 2), (b'{"tenant_id": "A"}', 3)], "value binary, offset bigint")
    kept, rest = chunk_messages(messages)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [r["offset"] for r in kept.collect()] == [0] and sorted(r["offset"] for r in rest.collect()) == [1, 2, 3]
