"""Queries over data quality, run logs and running streams, with their SQL twins."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.functions.convert import TRACE_START, to_message, utc_time
from gaugeloft.functions.measures import is_over
from gaugeloft.operators import gold as gold_ops
from gaugeloft.operators import quality, runs
from gaugeloft.operators.ranks import exact_percentiles
from gaugeloft.operators.silver import readings_from_messages, window_average
from gaugeloft.plans import tables
from gaugeloft.plans.point_queries import SQL_STORED
from gaugeloft.plans.reading_queries import rounded, sql_gold, sql_silver
from gaugeloft.plans.tables import naive, table
from gaugeloft.schemas import parse_schema
from gaugeloft.session import fresh_dir
from gaugeloft.sinks import keyed
from gaugeloft.sinks.files import append_run_log
from gaugeloft.sources.runlogs import read_run_logs
from gaugeloft.sources.topics import ALERT_TOPIC, CRITICAL_TOPIC, GOLD_TOPIC, RAW_TOPIC, SILVER_TOPIC, as_envelope, read_topic
from gaugeloft.streaming import pipelines
from gaugeloft.streaming.monitoring import MetricsListener, observed, read_metrics

METRICS_SECONDS = 120
ARRIVAL = datetime(2024, 1, 25, 12)
LINE_BOUNDS = {"l_quantity": (5, 45), "l_extendedprice": (None, 60000), "l_discount": (0.01, None)}
REQUIRED = ["price", "discount", "number"]


def no_lateness(spark, sf_dir) -> str:
    """As long as the data's time span, so that no replayed row is late."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    span = table(spark, sf_dir, "events").agg(F.max(seconds) - F.min(seconds)).first()[0] or 0
    return f"{span // 86_400 + 2} days"


def _holed_lines(spark, sf_dir) -> DataFrame:
    """Line items in which some values are missing."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.nullif(F.col("l_discount"), F.lit(0.05)).alias("discount"),
        F.when(F.col("l_extendedprice") >= 1000, F.col("l_extendedprice")).alias("price"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("number"),
    )


def range_check(spark, sf_dir):
    checked = quality.range_errors(table(spark, sf_dir, "lineitem"), LINE_BOUNDS)
    kind = F.when(F.size("_out_of_range") == 0, "kept").otherwise("excluded")
    return checked.groupBy(kind.alias("kind"), F.array_join("_out_of_range", ",").alias("columns")).agg(F.count("*").alias("rows"))


def completeness(spark, sf_dir):
    return quality.completeness_by(_holed_lines(spark, sf_dir), ["flag"], REQUIRED)


def completeness_rows(spark, sf_dir):
    marked = quality.completeness(_holed_lines(spark, sf_dir), [*REQUIRED, "gps_time"])
    return marked.groupBy(F.array_join("_missing", ",").alias("missing")).agg(F.count("*").alias("rows"))


def drift_guard(spark, sf_dir):
    return quality.null_ratios(_holed_lines(spark, sf_dir), REQUIRED)


def schema_validation(spark, sf_dir):
    schema = parse_schema(
        '{"fields": [{"name": "k", "type": "long"}, {"name": "kind", "type": "long"}, {"name": "at", "type": "string"}]}'
    )
    kind = F.when(F.col("event_type") == "view", F.lit("3")).when(F.col("event_type") == "click", F.lit('"x"'))
    tail = F.when(kind.isNotNull(), F.concat(F.lit(', "kind": '), kind)).otherwise("")
    at = F.when(F.col("event_id") % 3 == 0, ', "at": "noon"').otherwise("")
    messages = table(spark, sf_dir, "events").select(
        F.concat(F.rtrim(F.col("props"), F.lit("}")), tail, at, F.lit("}")).alias("value")
    )
    checked = quality.validate_messages(messages, "value", schema)
    return checked.groupBy(F.array_join("_errors", ",").alias("errors")).agg(F.count("*").alias("rows"), F.sum("k").alias("sum_k"))


def outliers_sd(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return quality.outliers_by_deviation(rows, ["event_type"], "value", 2.0)


def outliers_pct(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*tables.LINE_ORDER, "l_returnflag", "l_extendedprice")
    flagged = quality.outliers_by_percentile(rows, ["l_returnflag"], "l_extendedprice", 0.01, 0.99)
    return flagged.filter("is_outlier").select(*tables.LINE_ORDER, "l_extendedprice")


def percentiles(spark, sf_dir):
    exact = exact_percentiles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    )
    return exact.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("p01", "p50", "p95", "p100")])


def quality_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    flagged = quality.outliers_by_deviation(rows, ["event_type"], "value", 2.0)
    flags = {"outlier": F.col("is_outlier"), "over": is_over(F.col("value")), "missing": F.col("value").isNull()}
    summary = quality.quality_alerts(flagged, ["event_type"], flags, {"outlier": 0.01, "over": 0.16, "missing": 0.0})
    return summary.withColumn("alerts", F.array_join("alerts", ","))


def run_log(spark, sf_dir):
    """Log rows written as JSON lines and read back."""
    path = fresh_dir(spark, "run-log")
    rows = tables.runs(spark, sf_dir)
    append_run_log(runs.ingestion_record(rows, F.col("run_time")), path)
    logged = read_run_logs(spark, path)
    return logged.withColumn("errors", F.array_join("errors", "; "))


def completed_log(spark, sf_dir):
    return runs.completed_record(tables.completions(spark, sf_dir), F.lit("2025-03-13 12:42:56").cast("timestamp"))


def chunk_log(spark, sf_dir):
    chunks = tables.point_chunks(spark, sf_dir)
    at = F.lit("2025-03-13 12:42:56").cast("timestamp")
    logged = runs.chunk_record(chunks, at, (F.col("chunk_number") + 1).cast("double"))
    return logged.withColumn("chunk_number", F.col("chunk_number").cast("bigint"))


def run_log_stats(spark, sf_dir):
    stats = runs.run_statistics(tables.runs(spark, sf_dir))
    return stats.withColumns({c: F.round(c, 4) for c in ("mean_throughput", "mean_good_throughput", "mean_seconds")})


def run_log_trend(spark, sf_dir):
    """Means as totals, which end after two places: a mean can lie halfway between two roundings."""
    trend = naive(runs.run_trend(tables.runs(spark, sf_dir), F.col("run_time"), "30 days"))
    good_runs = F.col("success_rate") * F.col("runs")
    return trend.select(
        "tenant_id",
        "window_start",
        "window_end",
        "runs",
        "success_rate",
        F.round(F.col("mean_throughput") * F.col("runs"), 2).alias("throughput_total"),
        F.round(F.col("mean_good_throughput") * good_runs, 2).alias("good_throughput_total"),
        F.round(F.col("mean_seconds") * F.col("runs"), 2).alias("seconds_total"),
    )


def failure_patterns(spark, sf_dir):
    return runs.failure_patterns(tables.runs(spark, sf_dir))


def throughput_grid(spark, sf_dir):
    return runs.throughput_grid(tables.runs(spark, sf_dir), "tenant_id", "o_orderstatus", ["F", "O"], places=4)


def slow_runs(spark, sf_dir):
    trend = runs.run_trend(tables.runs(spark, sf_dir), F.col("run_time"), "30 days")
    alerts = runs.run_alerts(trend, min_throughput=600.0, max_error_rate=0.4, max_seconds=800.0)
    return naive(alerts.select("tenant_id", "window_start", F.array_join("reasons", ",").alias("reasons")))


def _streamed_readings(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    files = tables.file_count(spark)
    path = tables.staged_messages(spark, sf_dir, files)
    messages = read_topic(spark, RAW_TOPIC, "parquet", path, stream=True, per_trigger=-(-files // batches))
    return readings_from_messages(messages)


def streaming_silver(spark, sf_dir):
    root, checkpoint = fresh_dir(spark, "silver"), fresh_dir(spark, "checkpoint")
    averages = window_average(_streamed_readings(spark, sf_dir), watermark=no_lateness(spark, sf_dir))
    pipelines.run_silver(averages, root, checkpoint, bounded=True).awaitTermination()
    return rounded(keyed.read_silver(spark, root).drop("date"))


def stream_time_fallback(spark, sf_dir):
    """A topic in which every tenth reading carries no time and takes that of its message."""
    path, root = fresh_dir(spark, "raw-topic"), fresh_dir(spark, "silver")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - TRACE_START
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 != 0, seconds).alias("timestamp"),
        F.col("user_id").cast("string").alias("vm_id"),
        *[F.col("value").alias(c) for c in ("min_cpu", "max_cpu", "avg_cpu")],
    )
    as_envelope(to_message(rows, "vm_id"), RAW_TOPIC).withColumn("timestamp", utc_time(ARRIVAL)).write.parquet(path)
    readings = readings_from_messages(read_topic(spark, RAW_TOPIC, "parquet", path, stream=True), by_arrival=True)
    averages = window_average(readings, window="1 day", watermark=no_lateness(spark, sf_dir))
    pipelines.run_silver(averages, root, fresh_dir(spark, "checkpoint"), bounded=True).awaitTermination()
    return rounded(keyed.read_silver(spark, root).drop("date"))


def streaming_silver_topic(spark, sf_dir):
    """Table and topic from one stream; the topic holds several versions of a window, the last one counts."""
    root, topic, checkpoint = fresh_dir(spark, "silver"), fresh_dir(spark, "topic"), fresh_dir(spark, "checkpoint")
    averages = window_average(_streamed_readings(spark, sf_dir), window="1 day", watermark=no_lateness(spark, sf_dir))
    pipelines.run_silver(averages, root, checkpoint, pipelines.stored_topic(topic), bounded=True).awaitTermination()
    return rounded(gold_ops.silver_from_messages(read_topic(spark, SILVER_TOPIC, "parquet", topic)))


def streaming_gold(spark, sf_dir):
    silver_root, gold_root = fresh_dir(spark, "silver"), fresh_dir(spark, "gold")
    averages = window_average(_streamed_readings(spark, sf_dir), window="1 hour", watermark=no_lateness(spark, sf_dir))
    topic = fresh_dir(spark, "gold-topic")
    writer = pipelines.stored_topic(topic, GOLD_TOPIC)
    pipelines.silver_then_gold(averages, silver_root, gold_root, fresh_dir(spark, "checkpoint"), topic=writer)
    told = read_topic(spark, GOLD_TOPIC, "parquet", topic).select(F.col("key").cast("string").alias("vm_id"))
    return naive(keyed.read_gold(spark, gold_root).drop("processed_time").join(told, "vm_id"))


def streaming_alerts(spark, sf_dir):
    path = fresh_dir(spark, "alerts")
    pipelines.run_alerts(_streamed_readings(spark, sf_dir), path, fresh_dir(spark, "checkpoint"), bounded=True).awaitTermination()
    stored = read_topic(spark, ALERT_TOPIC, "parquet", path)
    body = F.from_json(F.col("value").cast("string"), "vm_id string, timestamp timestamp, max_cpu double, is_anomaly boolean")
    return naive(stored.select(body.alias("m")).select("m.*"))


def streaming_critical(spark, sf_dir):
    """In one batch: a window still filling up may be critical for a while, depending on where batches end."""
    path = fresh_dir(spark, "critical")
    readings = _streamed_readings(spark, sf_dir, batches=1)
    pipelines.run_critical(readings, path, fresh_dir(spark, "checkpoint"), "1 day", 0.17, bounded=True, watermark=no_lateness(spark, sf_dir)).awaitTermination()
    stored = read_topic(spark, CRITICAL_TOPIC, "parquet", path)
    body = F.from_json(F.col("value").cast("string"), "window_start timestamp, readings bigint, alerts bigint")
    return naive(stored.select(body.alias("m")).select("m.*"))


def stream_metrics(spark, sf_dir):
    """Rows and errors per micro-batch as a listener saw them, added up over the run."""
    path, root = fresh_dir(spark, "metrics"), fresh_dir(spark, "silver")
    readings = observed(_streamed_readings(spark, sf_dir), is_over(F.col("max_cpu")))
    averages = window_average(readings, window="1 day", watermark=no_lateness(spark, sf_dir))
    listener = MetricsListener(spark, path)
    spark.streams.addListener(listener)
    try:
        query = pipelines.run_silver(averages, root, fresh_dir(spark, "checkpoint"), bounded=True, name="metered")
        query.awaitTermination()
        last = query.lastProgress["batchId"]
        deadline = time.monotonic() + METRICS_SECONDS
        while listener.last_batch != last:
            if time.monotonic() > deadline:
                raise TimeoutError(f"no metrics of batch {last} within {METRICS_SECONDS} s")
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    return read_metrics(spark, path).groupBy("query_name").agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("observed_rows").alias("observed_rows"),
        F.sum("error_rows").alias("error_rows"),
        F.max("late_rows").alias("late_rows"),
    )


RATE = "round(CAST((o_totalprice / o_custkey)::VARCHAR AS DECIMAL(38, 18)), 2)::DOUBLE"
SQL_RUNS = f"""
    SELECT o_orderdate AS run_time, o_orderpriority AS tenant_id, 'order' || o_orderkey AS file_name, o_totalprice AS file_size_mb,
           o_custkey::DOUBLE AS ingestion_time_sec, CASE WHEN o_custkey > 0 THEN {RATE} ELSE 0 END AS throughput_mb_sec,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS records_processed,
           CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'success' END AS status, o_orderstatus, o_custkey, o_orderkey
    FROM orders"""
SQL_STATS = """count(*) AS runs, round(avg(throughput_mb_sec), 4) AS mean_throughput,
    round(avg(throughput_mb_sec) FILTER (WHERE status = 'success'), 4) AS mean_good_throughput,
    count(*) FILTER (WHERE status = 'success') / count(*)::DOUBLE AS success_rate, round(avg(ingestion_time_sec), 4) AS mean_seconds"""
SQL_TREND = f"""
    SELECT tenant_id, time_bucket(INTERVAL '30 days', run_time, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL '30 days', run_time, TIMESTAMP '1970-01-01') + INTERVAL '30 days' AS window_end, {SQL_STATS}
    FROM ({SQL_RUNS}) GROUP BY 1, 2, 3"""
SQL_RANGES = """concat_ws(',', CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 'l_quantity' END,
    CASE WHEN l_extendedprice > 60000 THEN 'l_extendedprice' END, CASE WHEN l_discount < 0.01 THEN 'l_discount' END)"""
SQL_HOLED = """
    SELECT l_returnflag AS flag, nullif(l_discount, 0.05) AS discount, CASE WHEN l_extendedprice >= 1000 THEN l_extendedprice END AS price,
           nullif(l_linenumber, 7) AS number FROM lineitem"""
SQL_OUTLIERS = """
    SELECT event_id, event_type, value, coalesce(abs(value - m) > 2.0 * s, FALSE) AS is_outlier
    FROM events JOIN (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1) USING (event_type)"""


def sql_text_silver(window: str) -> str:
    return f"SELECT * REPLACE (vm_id::VARCHAR AS vm_id) FROM ({sql_silver(window)})"


QUERIES = {
    "range_check": (
        range_check,
        f"SELECT CASE WHEN columns = '' THEN 'kept' ELSE 'excluded' END AS kind, columns, count(*) AS rows FROM (SELECT {SQL_RANGES} AS columns FROM lineitem) GROUP BY ALL",
    ),
    "completeness": (
        completeness,
        f"""SELECT flag, count(*) AS rows, count(*) FILTER (WHERE ok) AS complete_rows, bool_and(ok) AS is_complete
            FROM (SELECT *, price IS NOT NULL AND discount IS NOT NULL AND number IS NOT NULL AS ok FROM ({SQL_HOLED})) GROUP BY flag""",
    ),
    "completeness_rows": (
        completeness_rows,
        f"""SELECT concat_ws(',', CASE WHEN price IS NULL THEN 'price' END, CASE WHEN discount IS NULL THEN 'discount' END,
                   CASE WHEN number IS NULL THEN 'number' END, 'gps_time') AS missing, count(*) AS rows FROM ({SQL_HOLED}) GROUP BY 1""",
    ),
    "drift_guard": (
        drift_guard,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS field, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
                       count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE AS null_ratio,
                       count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE > 0.1 AS has_drifted FROM ({SQL_HOLED})"""
            for c in REQUIRED
        ),
    ),
    "schema_validation": (
        schema_validation,
        """SELECT concat_ws(',', CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 'wrong type kind' ELSE 'missing kind' END,
                  CASE WHEN event_id % 3 <> 0 THEN 'missing at' END) AS errors, count(*) AS rows,
                  sum(CAST(props ->> 'k' AS BIGINT))::BIGINT AS sum_k FROM events GROUP BY 1""",
    ),
    "outliers_sd": (outliers_sd, SQL_OUTLIERS),
    "outliers_pct": (
        outliers_pct,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
           FROM lineitem JOIN (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi
                               FROM lineitem GROUP BY 1) USING (l_returnflag)
           WHERE l_extendedprice < lo OR l_extendedprice > hi""",
    ),
    "percentiles": (
        percentiles,
        """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 4) AS p01, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
                  round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(quantile_cont(l_extendedprice, 1.0), 4) AS p100
           FROM lineitem GROUP BY 1""",
    ),
    "quality_summary": (
        quality_summary,
        f"""SELECT event_type, rows, outlier_rate, over_rate, missing_rate,
                   concat_ws(',', CASE WHEN outlier_rate > 0.01 THEN 'outlier' END, CASE WHEN over_rate > 0.16 THEN 'over' END,
                             CASE WHEN missing_rate > 0.0 THEN 'missing' END) AS alerts
            FROM (SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE is_outlier) / count(*)::DOUBLE AS outlier_rate,
                         count(*) FILTER (WHERE value > 90) / count(*)::DOUBLE AS over_rate,
                         count(*) FILTER (WHERE value IS NULL) / count(*)::DOUBLE AS missing_rate FROM ({SQL_OUTLIERS}) GROUP BY 1)""",
    ),
    "run_log": (
        run_log,
        f"""SELECT strftime(run_time, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", tenant_id, file_name, file_size_mb, ingestion_time_sec,
                   throughput_mb_sec, records_processed, CASE WHEN records_processed > 0 THEN 'success' ELSE 'error' END AS status,
                   CASE WHEN o_orderstatus = 'P' THEN 'timeout after ' || o_custkey || ' s; file order' || o_orderkey || ' incomplete' ELSE '' END AS errors
            FROM ({SQL_RUNS})""",
    ),
    "completed_log": (
        completed_log,
        f"""SELECT '2025-03-13T12:42:56Z' AS "timestamp", 'tenant' || tenant_id AS tenant_id, file_name || '.las' AS file_name, file_size_mb,
                   o_custkey AS total_points, ingestion_time_sec AS processing_time_sec, throughput_mb_sec, 'completed' AS status
            FROM ({SQL_RUNS}) WHERE o_orderstatus <> 'P'""",
    ),
    "chunk_log": (
        chunk_log,
        f"""SELECT '2025-03-13T12:42:56Z' AS "timestamp", tenant_id, file_name, chunk AS chunk_number, count(*) AS points_processed,
                   (chunk + 1)::DOUBLE AS processing_time_sec, round(count(*) * 192 / 1048576.0::DOUBLE / (chunk + 1), 2) AS throughput_mb_sec,
                   'success' AS status FROM ({SQL_STORED}) GROUP BY tenant_id, file_name, chunk""",
    ),
    "run_log_stats": (run_log_stats, f"SELECT tenant_id, {SQL_STATS} FROM ({SQL_RUNS}) GROUP BY tenant_id"),
    "run_log_trend": (
        run_log_trend,
        f"""SELECT tenant_id, time_bucket(INTERVAL '30 days', run_time, TIMESTAMP '1970-01-01') AS window_start,
                   time_bucket(INTERVAL '30 days', run_time, TIMESTAMP '1970-01-01') + INTERVAL '30 days' AS window_end, count(*) AS runs,
                   count(*) FILTER (WHERE status = 'success') / count(*)::DOUBLE AS success_rate,
                   round(sum(throughput_mb_sec), 2) AS throughput_total,
                   round(sum(throughput_mb_sec) FILTER (WHERE status = 'success'), 2) AS good_throughput_total,
                   round(sum(ingestion_time_sec), 2) AS seconds_total FROM ({SQL_RUNS}) GROUP BY 1, 2, 3""",
    ),
    "failure_patterns": (
        failure_patterns,
        """SELECT o_orderpriority AS tenant_id, p AS pattern, count(*) AS occurrences
           FROM (SELECT o_orderpriority, unnest(CASE WHEN o_orderstatus = 'P' THEN ['timeout after # s', 'file order# incomplete']
                                                     ELSE [NULL] END) AS p FROM orders) GROUP BY ALL""",
    ),
    "throughput_grid": (
        throughput_grid,
        f"""SELECT tenant_id, round(avg(throughput_mb_sec) FILTER (WHERE o_orderstatus = 'F'), 4) AS "F",
                   round(avg(throughput_mb_sec) FILTER (WHERE o_orderstatus = 'O'), 4) AS "O",
                   round(avg(throughput_mb_sec) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')), 4) AS other FROM ({SQL_RUNS}) GROUP BY 1""",
    ),
    "slow_runs": (
        slow_runs,
        f"""SELECT * FROM (SELECT tenant_id, window_start, concat_ws(',', CASE WHEN mean_throughput < 600 THEN 'throughput' END,
                   CASE WHEN 1 - success_rate > 0.4 THEN 'error rate' END, CASE WHEN mean_seconds > 800 THEN 'processing time' END) AS reasons
            FROM ({SQL_TREND})) WHERE reasons <> ''""",
    ),
    "streaming_silver_parity": (streaming_silver, sql_text_silver("3 minutes")),
    "stream_time_fallback": (
        stream_time_fallback,
        sql_text_silver("1 day").replace("FROM events", f"FROM (SELECT * REPLACE (CASE WHEN event_id % 10 = 0 THEN TIMESTAMP '{ARRIVAL}' ELSE ts END AS ts) FROM events)"),
    ),
    "streaming_silver_topic": (streaming_silver_topic, sql_text_silver("1 day")),
    "streaming_gold": (streaming_gold, sql_gold(sql_silver("1 hour", rounded=False), key="vm_id::VARCHAR")),
    "streaming_alerts": (
        streaming_alerts,
        """SELECT user_id::VARCHAR AS vm_id, date_trunc('second', ts) AS "timestamp", value AS max_cpu, TRUE AS is_anomaly
           FROM events WHERE value > 90""",
    ),
    "streaming_critical": (
        streaming_critical,
        """SELECT * FROM (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS readings,
                                 count(*) FILTER (WHERE value > 90) AS alerts FROM events GROUP BY 1) WHERE alerts / readings::DOUBLE > 0.17""",
    ),
    "stream_metrics": (
        stream_metrics,
        """SELECT 'metered' AS query_name, count(*) AS input_rows, count(*) AS observed_rows,
                  count(*) FILTER (WHERE value > 90) AS error_rows, 0::BIGINT AS late_rows FROM events""",
    ),
}
