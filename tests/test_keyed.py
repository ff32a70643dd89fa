from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeloft.operators.gold import windows_of
from gaugeloft.operators.latest import latest, split_null_keys
from gaugeloft.operators.points import stored_points
from gaugeloft.sinks import keyed

ROWS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50), st.integers(-5, 5)), unique_by=lambda r: (r[0], r[1]), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_latest_is_idempotent_and_order_free(spark, rows):
    want = sorted({k: (k, v, x) for k, v, x in sorted(rows, key=lambda r: r[1])}.values())
    for given_rows in (rows, rows[::-1]):
        df = spark.createDataFrame(given_rows, "k string, v bigint, x int")
        once = latest(df, ["k"], ["v"])
        assert sorted(tuple(r) for r in once.collect()) == want
        assert sorted(tuple(r) for r in latest(once, ["k"], ["v"]).collect()) == want
        texts = latest(df.withColumn("x", F.col("x").cast("string")), ["k"], ["v"])
        assert sorted((r.k, r.v, int(r.x)) for r in texts.collect()) == want


@pytest.mark.parametrize("kind", ["int", "string"])
def test_null_values_and_null_versions_survive(spark, kind):
    df = spark.createDataFrame([("a", 1, "1"), ("a", 2, None), ("b", None, "7")], "k string, v bigint, x string")
    got = latest(df.withColumn("x", F.col("x").cast(kind)), ["k"], ["v"]).collect()
    assert sorted((r.k, r.v, r.x and str(r.x)) for r in got) == [("a", 2, None), ("b", None, "7")]


def test_fixed_width_values_aggregate_by_hash_without_sorting(spark):
    df = spark.createDataFrame([("a", 1, 1.0, True)], "k string, v bigint, x double, f boolean")
    plan = latest(df, ["k"], ["v"])._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_null_keys_are_set_apart(spark, path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "vm_id string, n int")
    good, bad = split_null_keys(df, ["vm_id"])
    assert (good.count(), bad.count()) == (1, 1)
    keyed.write_version(df, path, 0, ["vm_id"])
    assert [tuple(r) for r in keyed.read_latest(spark, path, ["vm_id"]).collect()] == [("a", 1)]
    assert [(r.vm_id, r.n) for r in keyed.read_quarantine(spark, path).collect()] == [(None, 2)]


def silver(spark, rows):
    return spark.createDataFrame(rows, "vm_id string, window_start timestamp, window_end timestamp, avg_max_cpu double, is_window_anomaly boolean")


def row(vm, minute, average):
    return (vm, datetime(2024, 1, 1, 0, minute), datetime(2024, 1, 1, 0, minute + 3), average, average > 90)


def averages(spark, root):
    return sorted((r.vm_id, r.window_start.minute, r.avg_max_cpu) for r in keyed.read_silver(spark, root).collect())


def test_replayed_batch_leaves_nothing_twice(spark, path):
    keyed.upsert_silver(silver(spark, [row("a", 0, 93.0), row("b", 0, 1.0)]), path, 0)
    keyed.upsert_silver(silver(spark, [row("a", 0, 65.0)]), path, 1)
    keyed.upsert_silver(silver(spark, [row("a", 0, 65.0)]), path, 1)
    assert averages(spark, path) == [("a", 0, 65.0), ("b", 0, 1.0)]
    assert keyed.read_versions(spark, path).count() == 3


def test_rewriting_changes_nothing_for_readers(spark, path):
    for batch, value in enumerate([1.0, 2.0, 3.0]):
        keyed.upsert_silver(silver(spark, [row("a", 0, value), row("a", 3 * batch, value)]), f"{path}/old", batch)
    before = averages(spark, f"{path}/old")
    assert keyed.rewrite_silver(spark, f"{path}/old", f"{path}/new") == 2
    assert averages(spark, f"{path}/new") == before == averages(spark, f"{path}/old")
    assert keyed.read_versions(spark, f"{path}/new").count() == len(before) and keyed.version_range(spark, f"{path}/new") == (2, 2)
    keyed.upsert_silver(silver(spark, [row("a", 0, 9.0)]), f"{path}/new", 3)
    assert ("a", 0, 9.0) in averages(spark, f"{path}/new") and len(averages(spark, f"{path}/new")) == len(before)


POINTS = "tenant_id string, file_name string, chunk_number int, point_position int, X double"


def points(spark, rows):
    return stored_points(spark.createDataFrame(rows, POINTS), ["chunk_number"])


def xs(df):
    return sorted((r.tenant_id, r.file_name, r.x) for r in df.collect())


def test_a_chunk_sent_again_replaces_its_points_only(spark, path):
    keyed.upsert_points(points(spark, [("A", "f", c, i, 10.0 * c + i) for c in range(3) for i in range(4)] + [("B", "f", 0, 0, 5.0)]), path, 0)
    keyed.upsert_points(points(spark, [("A", "f", 1, i, 100.0 + i) for i in range(2)]), path, 1)
    want = sorted([("A", "f", float(x)) for x in (0, 1, 2, 3, 20, 21, 22, 23, 100, 101)] + [("B", "f", 5.0)])
    assert xs(keyed.read_points(spark, path)) == want
    assert "chunk_number" not in keyed.read_points(spark, path).columns
    keyed.rewrite_points(spark, path, f"{path}-new")
    assert xs(keyed.read_points(spark, f"{path}-new")) == want
    keyed.upsert_points(points(spark, [("A", "f", 0, 0, 7.0)]), f"{path}-new", 2)
    assert len(xs(keyed.read_points(spark, f"{path}-new"))) == len(want) - 3


def test_points_of_an_unfinished_batch_are_not_seen(spark, path):
    keyed.upsert_points(points(spark, [("A", "f", 0, 0, 1.0)]), path, 0)
    keyed.write_version(points(spark, [("A", "f", 0, 0, 2.0), ("A", "g", 0, 0, 3.0)]), path, 1, keyed.POINT_KEYS, ["tenant_id", "file_id"])
    assert xs(keyed.read_points(spark, path)) == [("A", "f", 1.0)]
    keyed.upsert_points(points(spark, []), path, 2)
    assert xs(keyed.read_points(spark, path)) == [("A", "f", 1.0)]


def test_points_are_read_without_an_exchange(spark, path):
    for batch in range(3):
        keyed.upsert_points(points(spark, [("A", "f", c, i, float(batch)) for c in range(batch, 4) for i in range(5)]), path, batch)
    df = keyed.read_points(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "HashAggregate" not in plan
    assert all("Broadcast" in line for line in plan.splitlines() if "Exchange" in line)
    assert sorted({(r.x) for r in df.collect()}) == [0.0, 1.0, 2.0] and df.count() == 20


def test_lookup_reaches_the_files(spark, path):
    keyed.upsert_silver(silver(spark, [row("a", 0, 1.0), row("b", 3, 2.0)]), path, 0)
    plan = keyed.read_silver(spark, path).filter("vm_id = 'a' AND date = DATE '2024-01-01'")._jdf.queryExecution().toString()
    assert "EqualTo(vm_id,a)" in plan and "date" in plan.split("PartitionFilters")[1]


def scanned_rows(df):
    """Rows that the scans of a query gave out when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes, found = [plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan], 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        nodes += [node.plan()] if "QueryStage" in name else []
    return found


def test_lookup_in_a_rewritten_table_skips_files(spark, path):
    rows = [(f"vm{vm:04}", datetime(2024, 1, day, hour), datetime(2024, 1, day, hour, 3), 1.0, False) for vm in range(400) for day in (1, 2, 3) for hour in range(4)]
    keyed.upsert_silver(silver(spark, rows).repartition(8), f"{path}/old", 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one file
    keyed.rewrite_silver(spark, f"{path}/old", f"{path}/new")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 2, 23)
    mine = lambda root: windows_of(keyed.read_silver(spark, root), "vm0123", start, end)
    assert mine(f"{path}/new").count() == 8 == mine(f"{path}/old").count()
    assert scanned_rows(mine(f"{path}/new")) <= len(rows) // 2 < scanned_rows(mine(f"{path}/old"))
    assert scanned_rows(windows_of(keyed.read_silver(spark, f"{path}/new"), "vm0123x", start, end)) == 0


def test_gold_keeps_the_last_run(spark, path):
    for run, total in enumerate([5, 6]):
        keyed.upsert_gold(spark.createDataFrame([("a", total, None)], "vm_id string, total_windows bigint, date_range_start timestamp"), path, run)
    assert [tuple(r) for r in keyed.read_gold(spark, path).collect()] == [("a", 6, None)]


def test_points_of_equal_depth_overwrite_each_other(spark, path):
    df = spark.createDataFrame([("l", 1.0, 5.0, 50.0, 0), ("l", 1.0, 6.0, 60.0, 1), ("l", 2.0, 7.0, 70.0, 2)], "lidar_id string, z double, x double, y double, at int")
    keyed.upsert_measurements(df, path, 0, ["at"])
    assert sorted((r.depth, r.value) for r in keyed.read_measurements(spark, path).collect()) == [(1.0, 6.0), (1.0, 60.0), (2.0, 7.0), (2.0, 70.0)]
