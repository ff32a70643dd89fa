"""Queries over points, chunks and LAS files, with their SQL twins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.functions.convert import to_message, utc_time
from gaugeloft.functions.naming import file_id, file_name_of, stem_of, tenant_of
from gaugeloft.operators.points import (
    CORE_DIMENSIONS,
    EXPORT_DIMENSIONS,
    chunk_in_order,
    core_points,
    file_stats,
    file_totals,
    first_points,
    latest_measurements,
    long_measurements,
    stored_points,
    unchunk,
)
from gaugeloft.plans.staging import stage_las
from gaugeloft.plans.tables import LINE_ORDER, completions, naive, point_chunks, points, table
from gaugeloft.session import fresh_dir, settle
from gaugeloft.sinks import keyed
from gaugeloft.sinks.files import export_points_csv
from gaugeloft.sources import las_records
from gaugeloft.sources.las import chunks_of, describe_las, list_las, read_las, watch_las
from gaugeloft.sources.runlogs import read_run_logs
from gaugeloft.sources.topics import CHUNK_TOPIC, COMPLETION_TOPIC, as_envelope, chunk_messages, completion_messages, peek_chunks, read_topic
from gaugeloft.streaming.pipelines import load_measurements, run_chunk_topics, run_las, run_las_topics, stored_topic

EVENT_CHUNK = 100
EXPORT_WANTED, EXPORT_CHUNK = 2500, 1000

SQL_POINTS = """
    SELECT *, l_returnflag AS flag,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS point_index
    FROM lineitem"""


def sql_uuid(name: str) -> str:
    sha = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    return f"""(substr({sha}, 1, 8) || '-' || substr({sha}, 9, 4) || '-5' || substr({sha}, 14, 3) || '-'
        || substr('89ab', ('0x' || substr({sha}, 17, 1))::INTEGER % 4 + 1, 1) || substr({sha}, 18, 3) || '-' || substr({sha}, 21, 12))"""


def chunk_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), *LINE_ORDER, "l_quantity")
    chunks = chunk_in_order(rows, ["flag"], LINE_ORDER, fields=["l_quantity", "l_orderkey"])
    return chunks.select(
        "flag",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        F.size("points").cast("bigint").alias("points"),
        F.aggregate("points", F.lit(0.0), lambda total, p: total + p["l_quantity"]).alias("quantity"),
        F.array_min(F.transform("points", lambda p: p["l_orderkey"])).alias("first_order"),
        F.array_max(F.transform("points", lambda p: p["l_orderkey"])).alias("last_order"),
    )


def chunk_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    flat = unchunk(chunk_in_order(events, ["event_type"], ["event_id"], EVENT_CHUNK, ["event_id", "value"]))
    return flat.withColumn("chunk_number", F.col("chunk_number").cast("bigint")).withColumn(
        "point_position", F.col("point_position").cast("bigint")
    )


def totals_per_file(spark, sf_dir):
    return file_totals(point_chunks(spark, sf_dir))


def points_table(spark, sf_dir):
    """Chunks stored twice, as after a replay; the ids make both writes the same rows."""
    root = fresh_dir(spark, "points")
    chunks = settle(point_chunks(spark, sf_dir))
    keyed.upsert_chunks(chunks, root, 0)
    keyed.upsert_chunks(chunks, root, 1)
    return keyed.read_points(spark, root)


def file_stats_table(spark, sf_dir):
    root = fresh_dir(spark, "file-stats")
    messages = completions(spark, sf_dir)
    for run, day in enumerate((12, 13)):
        keyed.upsert_file_stats(file_stats(messages, utc_time(datetime(2025, 3, day, 12, 42, 56))), root, run)
    return naive(keyed.read_file_stats(spark, root))


def points_numeric_tenants(spark, sf_dir):
    """Tenants whose names look like numbers, stored twice, rewritten, then joined by one with letters."""
    root, rewritten = fresh_dir(spark, "points"), fresh_dir(spark, "points")
    names = F.element_at(F.array(F.lit("007"), F.lit("1e5"), F.lit("B")), (F.col("event_id") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select(
        names.alias("tenant_id"), F.lit("f.las").alias("file_name"), F.lit(0).alias("chunk_number"), F.col("event_id").cast("int").alias("point_position"), F.col("user_id").alias("X")
    )
    for version, part in enumerate((rows.filter("tenant_id <> 'B'"), rows.filter("tenant_id = '007'"))):
        keyed.upsert_points(stored_points(part, ["chunk_number"]), root, version)
    keyed.rewrite_points(spark, root, rewritten)
    keyed.upsert_points(stored_points(rows.filter("tenant_id = 'B'"), ["chunk_number"]), rewritten, 2)
    stored = keyed.read_points(spark, rewritten)
    return stored.groupBy("tenant_id").agg(F.count("*").alias("points"), F.sum("x").alias("sum_x"))


def completion_versions(spark, sf_dir):
    """Each file completed twice, in two batches read by one trigger; the later batch counts, whatever its offsets."""
    stored, root = fresh_dir(spark, "completions"), fresh_dir(spark, "stats")
    messages = to_message(completions(spark, sf_dir).drop("total_points").withColumn("total_points", F.lit(100)), "tenant_id")
    later = to_message(completions(spark, sf_dir).withColumn("status", F.lit("completed")), "tenant_id")
    for batch, (rows, shift) in enumerate(((messages, 1 << 40), (later, 0))):
        placed = as_envelope(rows, COMPLETION_TOPIC).withColumn("offset", F.col("offset") + shift)
        placed.write.parquet(f"{stored}/batch_id={batch}")
    told = completion_messages(read_topic(spark, COMPLETION_TOPIC, "parquet", stored, stream=True))[0]
    none = chunk_messages(read_topic(spark, CHUNK_TOPIC, "parquet", stored, stream=True))[0]
    for query in run_chunk_topics(none, told, fresh_dir(spark, "points"), root, fresh_dir(spark, "checkpoint"), bounded=True):
        query.awaitTermination()
    return keyed.read_file_stats(spark, root).select("file_name", "records_processed")


def _as_lidar(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("lidar_id"),
        F.col("l_quantity").alias("z"),
        F.col("l_extendedprice").alias("x"),
        F.col("l_discount").alias("y"),
        *LINE_ORDER,
    )


def measurements(spark, sf_dir):
    return long_measurements(_as_lidar(spark, sf_dir), LINE_ORDER)


def measurements_latest(spark, sf_dir):
    return latest_measurements(_as_lidar(spark, sf_dir), LINE_ORDER)


def measurements_table(spark, sf_dir):
    root = fresh_dir(spark, "measurements")
    keyed.upsert_measurements(_as_lidar(spark, sf_dir), root, 0, LINE_ORDER)
    return keyed.read_measurements(spark, root)


def path_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        tenant_of(url, prefix="th", default="none").alias("tenant"),
        file_name_of(url).alias("file_name"),
        stem_of(url).alias("stem"),
    )


def file_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", file_id(F.col("source"), F.col("doc_id").cast("string")).alias("file_id")
    )


def staged_las(spark: SparkSession, sf_dir: str) -> str:
    """Line items as LAS files in one directory per return flag."""
    root = fresh_dir(spark, "las")
    rows = points(spark, sf_dir, ["l_quantity", "l_extendedprice"]).select(
        "flag",
        "point_index",
        F.col("l_partkey").cast("int").alias("X"),
        F.col("l_suppkey").cast("int").alias("Y"),
        F.col("l_quantity").cast("int").alias("Z"),
        (F.col("l_linenumber") * 100).alias("intensity"),
        (F.col("l_linenumber") % 8).alias("classification"),
        (F.col("l_suppkey") % 65536).cast("int").alias("point_source_id"),
        F.col("l_extendedprice").alias("gps_time"),
    )
    stage_las(rows, root).agg(F.sum("points")).collect()
    return root


def las_scan(spark, sf_dir):
    columns = ["tenant_id", "file_name", "point_index", "X", "scaled_x", "scaled_z", "intensity", "classification", "gps_time"]
    scanned = read_las(spark, staged_las(spark, sf_dir), columns, split_bytes=1 << 20, recursive=True)
    return scanned.groupBy("tenant_id", "file_name").agg(
        F.count("*").alias("points"),
        F.max("point_index").alias("last_index"),
        F.sum(F.col("X").cast("bigint")).alias("sum_raw_x"),
        F.sum("scaled_x").alias("sum_x"),
        F.sum("scaled_z").alias("sum_z"),
        F.sum(F.col("intensity").cast("bigint")).alias("sum_intensity"),
        F.sum(F.col("classification").cast("bigint")).alias("sum_class"),
        F.max("gps_time").alias("last_time"),
    )


def las_one_tenant(spark, sf_dir):
    scanned = read_las(spark, staged_las(spark, sf_dir), ["tenant_id", "file_name", "point_index", "Z"], recursive=True)
    return scanned.filter(F.col("tenant_id") == "tenantA").select("file_name", "point_index", F.col("Z").cast("bigint").alias("Z"))


def las_core_points(spark, sf_dir):
    places = ["tenant_id", "file_name", "point_index"]
    core = core_points(read_las(spark, staged_las(spark, sf_dir), [*places, *CORE_DIMENSIONS], recursive=True), places)
    return core.select("tenant_id", "file_name", "point_index", *[F.col(c).cast("bigint").alias(c) for c in CORE_DIMENSIONS])


def las_chunks(spark, sf_dir):
    chunks = chunks_of(list_las(spark, staged_las(spark, sf_dir), recursive=True), split_bytes=100_000)
    return chunks.select(
        "tenant_id",
        "file_name",
        F.col("chunk_number").cast("bigint").alias("chunk_number"),
        F.size("points").cast("bigint").alias("points"),
        F.aggregate("points", F.lit(0).cast("bigint"), lambda total, p: total + p["X"]).alias("sum_x"),
    )


def las_first_points(spark, sf_dir):
    scanned = read_las(spark, staged_las(spark, sf_dir), ["file_name", "point_index", "X"], recursive=True)
    kept = first_points(scanned, EXPORT_WANTED, "point_index", EXPORT_CHUNK)
    return kept.groupBy("file_name").agg(F.count("*").alias("points"), F.sum(F.col("X").cast("bigint")).alias("sum_x"))


def las_export(spark, sf_dir):
    out = fresh_dir(spark, "las-csv")
    have = set(las_records.all_dimensions())
    columns = ["file_name", "point_index", *[c for c in EXPORT_DIMENSIONS if c in have]]
    export_points_csv(read_las(spark, staged_las(spark, sf_dir), columns, recursive=True), out)
    rows = spark.read.option("header", True).csv(out)
    return rows.select(*[F.col(c).cast("bigint").alias(c) for c in CORE_DIMENSIONS], F.col("gps_time").cast("double"), "x_t")


def las_measurements(spark, sf_dir):
    root = fresh_dir(spark, "measurements")
    columns = ["file_name", "point_index", "scaled_x", "scaled_y", "scaled_z"]
    load_measurements(read_las(spark, staged_las(spark, sf_dir), columns, recursive=True), root, 0)
    return keyed.read_measurements(spark, root)


def las_description(spark, sf_dir):
    described = describe_las(spark, f"{staged_las(spark, sf_dir)}/tenantA/A_0.las")
    return described.filter(F.col("dimension").isin("X", "Y", "Z")).select("file_name", "point_index", "dimension", "value")


def las_arrivals(spark, sf_dir):
    """LAS files picked up by a stream and stored as points."""
    root, table_root, checkpoint = staged_las(spark, sf_dir), fresh_dir(spark, "arrived"), fresh_dir(spark, "checkpoint")
    run_las(watch_las(spark, f"{root}/*", per_trigger=100), table_root, checkpoint, bounded=True).awaitTermination()
    return keyed.read_points(spark, table_root)


def _chunk_envelopes(spark, sf_dir) -> DataFrame:
    return as_envelope(to_message(point_chunks(spark, sf_dir), "tenant_id"), CHUNK_TOPIC)


def chunk_topics(spark, sf_dir):
    """Chunk and completion topics consumed side by side; points counted per file against the announced totals."""
    stored, roots = fresh_dir(spark, "two-topics"), [fresh_dir(spark, n) for n in ("points", "stats")]
    _chunk_envelopes(spark, sf_dir).write.parquet(f"{stored}/chunks")
    chunks = read_topic(spark, CHUNK_TOPIC, "parquet", f"{stored}/chunks")
    announced = file_totals(chunk_messages(chunks)[0]).select(
        "*", F.lit("completed").alias("status"), F.lit(30.0).alias("file_size_mb"), F.lit(15.0).alias("processing_time_sec")
    )
    as_envelope(to_message(announced, "tenant_id"), COMPLETION_TOPIC).write.parquet(f"{stored}/completions")
    data = read_topic(spark, CHUNK_TOPIC, "parquet", f"{stored}/chunks", stream=True)
    meta = read_topic(spark, COMPLETION_TOPIC, "parquet", f"{stored}/completions", stream=True)
    running = run_chunk_topics(
        chunk_messages(data)[0], completion_messages(meta)[0], *roots, fresh_dir(spark, "checkpoint"), bounded=True
    )
    for query in running:
        query.awaitTermination()
    counted = keyed.read_points(spark, roots[0]).groupBy("file_id").agg(F.count("*").alias("points"), F.round(F.sum("z"), 2).alias("sum_z"))
    return counted.join(keyed.read_file_stats(spark, roots[1]), "file_id").select("file_name", "points", "sum_z", "records_processed", "status")


def las_topics(spark, sf_dir):
    """LAS files published by a stream: messages and points per file against the announced totals and the log."""
    root, out = staged_las(spark, sf_dir), fresh_dir(spark, "las-topics")
    writers = [stored_topic(f"{out}/{t}", t, key="tenant_id") for t in (CHUNK_TOPIC, COMPLETION_TOPIC)]
    files = watch_las(spark, f"{root}/*", per_trigger=100)
    run_las_topics(files, *writers, f"{out}/log", fresh_dir(spark, "checkpoint"), bounded=True).awaitTermination()
    sent = file_totals(chunk_messages(read_topic(spark, CHUNK_TOPIC, "parquet", f"{out}/{CHUNK_TOPIC}"))[0])
    told = completion_messages(read_topic(spark, COMPLETION_TOPIC, "parquet", f"{out}/{COMPLETION_TOPIC}"))[0]
    logged = read_run_logs(spark, f"{out}/log").select("file_name", "records_processed", F.col("status").alias("log_status"))
    announced = told.select("file_name", F.col("total_points").alias("announced_points"), F.col("total_chunks").alias("announced_chunks"), "status")
    return sent.join(announced, "file_name").join(logged, "file_name")


def chunk_peek(spark, sf_dir):
    """Messages in one partition, in order of file and chunk, so that the first one is known."""
    body = F.col("value").cast("string")
    file, number = F.get_json_object(body, "$.file_name"), F.get_json_object(body, "$.chunk_number").cast("bigint")
    placed = _chunk_envelopes(spark, sf_dir).withColumns({"partition": F.lit(0), "offset": F.ascii(file) * 1_000_000 + number})
    return peek_chunks(placed).select(
        "topic", "tenant_id", "file_name", F.col("chunk_number").cast("bigint").alias("chunk_number"), "point_count", F.col("first_point.X").cast("double").alias("first_x")
    )


LAS_FILE = "flag || '_' || (point_index // 100000) || '.las'"
SQL_STORED = f"""
    SELECT {sql_uuid("'tenant' || flag || ':' || flag || '.las'")} AS file_id, 'tenant' || flag AS tenant_id, flag || '.las' AS file_name,
           l_partkey::DOUBLE AS x, l_suppkey::DOUBLE AS y, l_quantity AS z,
           CASE WHEN l_linenumber <> 3 THEN l_extendedprice ELSE 0 END AS intensity,
           CASE WHEN l_linenumber <> 4 THEN l_linenumber ELSE 0 END AS classification,
           l_linenumber AS point_source_id, 0::INTEGER AS scan_angle_rank,
           point_index // 10000 AS chunk, point_index % 10000 AS place
    FROM ({SQL_POINTS})"""
SQL_LONG = """
    SELECT l_returnflag AS lidar_id, l_quantity::FLOAT AS depth, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           'x' AS measurement_type, l_extendedprice::FLOAT AS value FROM lineitem
    UNION ALL
    SELECT l_returnflag, l_quantity::FLOAT, l_orderkey, l_linenumber, l_partkey, l_suppkey, 'y', l_discount::FLOAT FROM lineitem"""
SQL_LATEST = f"""
    SELECT lidar_id, depth, measurement_type, arg_max(value, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS value
    FROM ({SQL_LONG}) GROUP BY ALL"""
SQL_LAS = f"""
    SELECT 'tenant' || flag AS tenant_id, {LAS_FILE} AS file_name, point_index % 100000 AS point_index, flag,
           l_partkey AS "X", l_suppkey AS "Y", l_quantity::BIGINT AS "Z", (l_linenumber * 100)::BIGINT AS intensity,
           (l_linenumber % 8)::BIGINT AS classification, (l_suppkey % 65536)::BIGINT AS point_source_id, l_extendedprice AS gps_time
    FROM ({SQL_POINTS})"""

QUERIES = {
    "chunk_counts": (
        chunk_counts,
        f"""SELECT flag, point_index // 10000 AS chunk_number, count(*) AS points, sum(l_quantity) AS quantity,
                   min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM ({SQL_POINTS}) GROUP BY ALL""",
    ),
    "chunk_roundtrip": (
        chunk_roundtrip,
        f"""SELECT event_type, n // {EVENT_CHUNK} AS chunk_number, n % {EVENT_CHUNK} AS point_position, event_id, value
            FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n FROM events)""",
    ),
    "file_totals": (
        totals_per_file,
        f"""SELECT 'tenant' || flag AS tenant_id, flag || '.las' AS file_name, count(*) AS total_points,
                   count(DISTINCT point_index // 10000) AS total_chunks FROM ({SQL_POINTS}) GROUP BY ALL""",
    ),
    "points_table": (
        points_table,
        f"SELECT * EXCLUDE (chunk, place), {sql_uuid('file_id || chr(58) || chunk || chr(58) || place')} AS point_id FROM ({SQL_STORED})",
    ),
    "file_stats_table": (
        file_stats_table,
        f"""SELECT {sql_uuid("'tenant' || o_orderpriority || ':order' || o_orderkey || '.las'")} AS file_id,
                   'tenant' || o_orderpriority AS tenant_id, 'order' || o_orderkey || '.las' AS file_name,
                   o_totalprice AS file_size_mb, o_custkey::DOUBLE AS ingestion_time_sec, o_custkey AS records_processed,
                   'completed' AS status, '[]' AS errors, TIMESTAMP '2025-03-13 12:42:56' AS timestamp FROM orders WHERE o_orderstatus <> 'P'""",
    ),
    "points_numeric_tenants": (
        points_numeric_tenants,
        "SELECT ['007', '1e5', 'B'][event_id % 3 + 1] AS tenant_id, count(*) AS points, sum(user_id)::DOUBLE AS sum_x FROM events GROUP BY 1",
    ),
    "completion_versions": (completion_versions, "SELECT 'order' || o_orderkey || '.las' AS file_name, o_custkey AS records_processed FROM orders"),
    "unpivot_measurements": (measurements, SQL_LONG),
    "measurements_latest": (measurements_latest, SQL_LATEST),
    "measurements_table": (measurements_table, SQL_LATEST),
    "path_parts": (
        path_parts,
        """SELECT page_id, coalesce(list_filter(string_split(url, '/'), lambda p: starts_with(p, 'th'))[1], 'none') AS tenant,
                  string_split(url, '/')[-1] AS file_name, string_split(string_split(url, '/')[-1], '.')[1] AS stem FROM pages""",
    ),
    "file_id": (file_ids, f"SELECT doc_id, {sql_uuid('source || chr(58) || doc_id')} AS file_id FROM documents"),
    "las_scan": (
        las_scan,
        f"""SELECT tenant_id, file_name, count(*) AS points, max(point_index) AS last_index, sum("X")::BIGINT AS sum_raw_x,
                   sum("X" * 0.5::DOUBLE + 100) AS sum_x, sum("Z" * 0.5::DOUBLE + 300) AS sum_z, sum(intensity)::BIGINT AS sum_intensity,
                   sum(classification)::BIGINT AS sum_class, max(gps_time) AS last_time FROM ({SQL_LAS}) GROUP BY ALL""",
    ),
    "las_one_tenant": (las_one_tenant, f"""SELECT file_name, point_index, "Z" FROM ({SQL_LAS}) WHERE flag = 'A'"""),
    "las_core_points": (
        las_core_points,
        f"""SELECT tenant_id, file_name, point_index, "X", "Y", "Z", intensity, classification, point_source_id FROM ({SQL_LAS})""",
    ),
    "las_chunks": (
        las_chunks,
        f"""SELECT tenant_id, file_name, point_index // 10000 AS chunk_number, count(*) AS points, sum("X")::BIGINT AS sum_x
            FROM ({SQL_LAS}) GROUP BY ALL""",
    ),
    "las_first_points": (
        las_first_points,
        f"""SELECT file_name, count(*) AS points, sum("X")::BIGINT AS sum_x FROM ({SQL_LAS})
            WHERE point_index < ceil({EXPORT_WANTED} / {EXPORT_CHUNK}.0) * {EXPORT_CHUNK} GROUP BY ALL""",
    ),
    "las_export": (
        las_export,
        f"""SELECT "X", "Y", "Z", intensity, classification, point_source_id, gps_time, NULL::VARCHAR AS x_t FROM ({SQL_LAS})""",
    ),
    "las_measurements": (
        las_measurements,
        f"""SELECT string_split(file_name, '.')[1] AS lidar_id, ("Z" * 0.5::DOUBLE + 300)::FLOAT AS depth, 'x' AS measurement_type,
                   arg_max(("X" * 0.5::DOUBLE + 100)::FLOAT, point_index) AS value FROM ({SQL_LAS}) GROUP BY 1, 2
            UNION ALL
            SELECT string_split(file_name, '.')[1], ("Z" * 0.5::DOUBLE + 300)::FLOAT, 'y',
                   arg_max(("Y" * 0.5::DOUBLE + 200)::FLOAT, point_index) FROM ({SQL_LAS}) GROUP BY 1, 2""",
    ),
    "las_describe": (
        las_description,
        f"""SELECT file_name, point_index, dimension, value::DOUBLE AS value
            FROM (SELECT file_name, point_index, "X", "Y", "Z" FROM ({SQL_LAS}) WHERE file_name = 'A_0.las' AND point_index < 5)
            UNPIVOT (value FOR dimension IN ("X", "Y", "Z"))""",
    ),
    "las_arrivals": (
        las_arrivals,
        f"""WITH f AS (SELECT *, {sql_uuid("tenant_id || ':' || file_name")} AS file_id FROM ({SQL_LAS}))
            SELECT file_id, tenant_id, file_name,
                   {sql_uuid("file_id || ':' || (point_index // 10000) || ':' || (point_index % 10000)")} AS point_id,
                   "X"::DOUBLE AS x, "Y"::DOUBLE AS y, "Z"::DOUBLE AS z, intensity::DOUBLE AS intensity,
                   classification::INTEGER AS classification, point_source_id::INTEGER AS point_source_id, 0::INTEGER AS scan_angle_rank
            FROM f""",
    ),
    "chunk_topics": (
        chunk_topics,
        f"""SELECT file_name, count(*) AS points, round(sum(z), 2) AS sum_z, count(*) AS records_processed, 'completed' AS status
            FROM ({SQL_STORED}) GROUP BY file_name""",
    ),
    "las_topics": (
        las_topics,
        f"""SELECT tenant_id, file_name, count(*) AS total_points, count(DISTINCT point_index // 10000) AS total_chunks,
                   count(*) AS announced_points, count(DISTINCT point_index // 10000) AS announced_chunks, 'completed' AS status,
                   count(*) AS records_processed, 'success' AS log_status FROM ({SQL_LAS}) GROUP BY tenant_id, file_name""",
    ),
    "chunk_peek": (
        chunk_peek,
        f"""SELECT 'raw-data' AS topic, tenant_id, file_name, chunk AS chunk_number, count(*) AS point_count, arg_min(x, place) AS first_x
            FROM ({SQL_STORED}) GROUP BY ALL ORDER BY file_name, chunk LIMIT 1""",
    ),
}
