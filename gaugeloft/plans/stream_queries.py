"""Queries over late rows, files that come in parts and runs side by side, with their SQL twins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.functions.convert import to_message, utc_time
from gaugeloft.operators.concurrency import throughput_by_concurrency
from gaugeloft.operators.joins import join_small
from gaugeloft.operators.points import chunk_in_order
from gaugeloft.operators.runs import failure_templates
from gaugeloft.plans.reading_queries import SQL_READINGS, rounded
from gaugeloft.plans.tables import LINE_ORDER, naive, readings, runs, table
from gaugeloft.session import fresh_dir, settle
from gaugeloft.sinks import keyed
from gaugeloft.sources.topics import CHUNK_TOPIC, COMPLETION_TOPIC, as_envelope, chunk_messages, read_topic
from gaugeloft.streaming.quantiles import RANK_ERROR, read_quantiles, run_outliers
from gaugeloft.streaming.stateful import file_completeness, read_late, run_completeness, run_silver_keeping_late

BATCHES, LATENESS, LATE_WINDOW = 4, "10 days", "6 hours"
PARTS = 500
SENT, CLOSED = datetime(2024, 2, 1), datetime(2024, 2, 2)


def _kept_late(spark, sf_dir) -> tuple[str, str]:
    """Readings sent in four batches that each span the whole time; the silver table and that of late rows."""
    path, root, late = (fresh_dir(spark, n) for n in ("readings", "silver", "late"))
    rows = readings(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    for batch in range(BATCHES):
        rows.filter(F.col("event_id") % BATCHES == batch).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    run_silver_keeping_late(stream, root, late, fresh_dir(spark, "checkpoint"), bounded=True, window=LATE_WINDOW, watermark=LATENESS).awaitTermination()
    return root, late


def streaming_late_rows(spark, sf_dir) -> DataFrame:
    return naive(read_late(spark, _kept_late(spark, sf_dir)[1]))


def streaming_on_time(spark, sf_dir) -> DataFrame:
    return rounded(keyed.read_silver(spark, _kept_late(spark, sf_dir)[0]).drop("date"))


SQL_MARKED = f"""
    SELECT *, time_bucket(INTERVAL '{LATE_WINDOW}', event_time) AS window_start, time_bucket(INTERVAL '{LATE_WINDOW}', event_time) + INTERVAL '{LATE_WINDOW}' AS window_end,
           coalesce(window_end <= (SELECT max(event_time) FROM ({SQL_READINGS}) e WHERE e.event_id % {BATCHES} < r.event_id % {BATCHES}) - INTERVAL '{LATENESS}', FALSE) AS late
    FROM ({SQL_READINGS}) r WHERE event_time IS NOT NULL"""


def stream_file_completeness(spark, sf_dir) -> DataFrame:
    """Three files in chunks: one whole, one without its last chunk, one without a completion message."""
    stored = fresh_dir(spark, "two-topics")
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("tenant"), "l_returnflag").alias("tenant_id"), F.concat("l_returnflag", F.lit(".las")).alias("file_name"), *LINE_ORDER, F.col("l_quantity").alias("Z")
    )
    chunks = settle(chunk_in_order(lines, ["tenant_id", "file_name"], LINE_ORDER, PARTS, ["Z"]))
    totals = chunks.groupBy("tenant_id", "file_name").agg(F.sum(F.size("points").cast("bigint")).alias("total_points"), F.count("*").alias("total_chunks"))
    told = totals.filter("file_name <> 'R.las'").withColumn("status", F.lit("completed"))
    last = totals.select("tenant_id", "file_name", (F.col("total_chunks") - 1).cast("int").alias("chunk_number")).filter("file_name = 'N.las'")
    sent = chunks.join(F.broadcast(last), ["tenant_id", "file_name", "chunk_number"], "left_anti")
    # A message long after the others in each topic moves the time on, so that waiting ends.
    tick = spark.createDataFrame([("tick", "tick", 0, [])], "tenant_id string, file_name string, chunk_number int, points array<struct<Z: double>>")
    idle = spark.createDataFrame([("tick", "tick", 0, 0, "idle")], "tenant_id string, file_name string, total_points bigint, total_chunks bigint, status string")
    twice = sent.unionByName(sent.filter("chunk_number = 0"))
    for name, topic, batches in (("chunks", CHUNK_TOPIC, (twice, tick)), ("completions", COMPLETION_TOPIC, (told, idle))):
        for rows, at in zip(batches, (SENT, CLOSED), strict=True):
            as_envelope(to_message(rows, "tenant_id"), topic).withColumn("timestamp", utc_time(at)).coalesce(1).write.mode("append").parquet(f"{stored}/{name}")
    data, meta = (read_topic(spark, topic, "parquet", f"{stored}/{name}", stream=True, per_trigger=1) for name, topic in (("chunks", CHUNK_TOPIC), ("completions", COMPLETION_TOPIC)))
    out = fresh_dir(spark, "verdicts")
    verdicts = file_completeness(data, meta, patience="1 hour")
    run_completeness(verdicts, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch_id={n}"), fresh_dir(spark, "checkpoint"), bounded=True).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def concurrency(spark, sf_dir) -> DataFrame:
    """Orders as ingestion runs of as many minutes as their customer has numbers."""
    rate = F.try_divide(F.col("file_size_mb"), F.col("ingestion_time_sec"))
    logs = runs(spark, sf_dir).withColumns({"throughput_mb_sec": rate, "ingestion_time_sec": F.col("ingestion_time_sec") * 60})
    return throughput_by_concurrency(logs, places=3)


def templates(spark, sf_dir) -> DataFrame:
    """Errors with paths, hosts, ids and the names of customers' segments in them."""
    order, number = F.col("o_orderkey"), F.col("o_custkey")
    errors = F.array(
        F.concat(F.lit("cannot open /data/"), F.translate("tenant_id", " ", "_"), F.lit("/order"), order, F.lit(".las on node-"), number % 40, F.lit(".example.org")),
        F.concat(F.lit("timeout after "), number, F.lit(" s")),
        F.when(number % 2 == 0, F.concat(F.lit("file order"), order, F.lit(" incomplete"))).otherwise(F.concat(F.lit("checksum of chunk differs: "), F.md5(order.cast("string")))),
    )
    logs = runs(spark, sf_dir).withColumn("number", F.regexp_extract("file_name", "[0-9]+", 0)).withColumnRenamed("errors", "_")
    logs = logs.withColumns({"o_orderkey": F.col("number").cast("bigint"), "o_custkey": F.col("ingestion_time_sec").cast("bigint")})
    return failure_templates(logs.withColumn("errors", F.when(F.col("status") == "error", errors).otherwise(F.array().cast("array<string>"))))


def stream_outliers(spark, sf_dir) -> DataFrame:
    """Running percentiles of a stream in four batches: whether each is as near its rank as stated."""
    path, root, outliers = (fresh_dir(spark, n) for n in ("readings", "sketches", "outliers"))
    rows = readings(spark, sf_dir)
    for batch in range(BATCHES):
        rows.filter(F.col("event_id") % BATCHES == batch).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    run_outliers(stream, root, outliers, fresh_dir(spark, "checkpoint"), ["tenant_id"], "max_cpu", bounded=True).awaitTermination()
    fractions = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = settle(read_quantiles(spark, root, ["tenant_id"], fractions))
    ranked = join_small(rows.filter(F.col("max_cpu").isNotNull()), found, ["tenant_id"]).groupBy("tenant_id", "n")
    slack = F.greatest(F.lit(RANK_ERROR), 1 / F.col("n"))
    below, upto = ({p: F.avg((F.col("max_cpu") < F.col(p)).cast("double") if strict else (F.col("max_cpu") <= F.col(p)).cast("double")) for p in fractions} for strict in (True, False))
    shares = ranked.agg(*[below[p].alias(f"{p}_below") for p in fractions], *[upto[p].alias(f"{p}_upto") for p in fractions])
    near = [((F.col(f"{p}_below") - slack <= f) & (F.col(f"{p}_upto") + slack >= f)).alias(p) for p, f in fractions.items()]
    return shares.select("tenant_id", "n", *near)


def chunk_rejected(spark, sf_dir) -> DataFrame:
    """What a topic of chunks holds besides: messages without points, and some that are no messages at all."""
    points = F.when(F.col("event_id") % 7 != 0, F.array(F.struct(F.col("value").alias("Z"))))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("tenant_id"), F.col("event_id").cast("string").alias("file_name"), points.alias("points"))
    messages = as_envelope(to_message(rows.drop("event_id"), "tenant_id"), CHUNK_TOPIC)
    text = F.col("value").cast("string")
    number = F.get_json_object(text, "$.file_name").cast("bigint")
    broken = messages.withColumn("value", F.when(number % 11 == 0, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text).cast("binary"))
    rejected = chunk_messages(broken)[1]
    return rejected.groupBy(F.col("key").cast("string").alias("tenant_id")).agg(F.count("*").alias("messages"))


QUERIES = {
    "chunk_rejected": (chunk_rejected, "SELECT event_type AS tenant_id, count(*) AS messages FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY 1"),
    "failure_templates": (
        templates,
        """WITH errors AS (
             SELECT o_orderpriority AS tenant_id, unnest(CASE WHEN o_orderstatus <> 'P' THEN [NULL] ELSE [
               'cannot open ' || o_orderkey, 'timeout ' || o_custkey, CASE WHEN o_custkey % 2 = 0 THEN 'file ' ELSE 'checksum ' END || o_orderkey] END) AS error FROM orders)
           SELECT tenant_id, CASE string_split(error, ' ')[1] WHEN 'cannot' THEN 'cannot open * on *' WHEN 'timeout' THEN 'timeout after * s' WHEN 'file' THEN 'file * incomplete'
                  WHEN 'checksum' THEN 'checksum of chunk differs: *' END AS template, count(*) AS occurrences, count(DISTINCT error) AS distinct_messages
           FROM errors GROUP BY ALL""",
    ),
    "stream_outliers": (stream_outliers, "SELECT event_type AS tenant_id, count(value) AS n, TRUE AS p01, TRUE AS p50, TRUE AS p95, TRUE AS p99 FROM events GROUP BY 1"),
    "streaming_late_rows": (streaming_late_rows, f"SELECT vm_id, window_start, window_end, event_time, max_cpu FROM ({SQL_MARKED}) WHERE late"),
    "streaming_on_time": (
        streaming_on_time,
        f"""SELECT vm_id, window_start, window_end, round(avg(max_cpu), 6) AS avg_max_cpu, coalesce(avg(max_cpu) > 90, FALSE) AS is_window_anomaly
            FROM ({SQL_MARKED}) WHERE NOT late GROUP BY vm_id, window_start, window_end""",
    ),
    "stream_file_completeness": (
        stream_file_completeness,
        f"""SELECT 'tenant' || l_returnflag AS tenant_id, l_returnflag || '.las' AS file_name,
                   CASE l_returnflag WHEN 'N' THEN 'short' WHEN 'R' THEN 'timed out' ELSE 'complete' END AS verdict,
                   CASE l_returnflag WHEN 'N' THEN (count(*) - 1) // {PARTS} * {PARTS} ELSE count(*) END AS received_points,
                   (count(*) - 1) // {PARTS} + CASE l_returnflag WHEN 'N' THEN 0 ELSE 1 END AS received_chunks,
                   CASE WHEN l_returnflag <> 'R' THEN count(*) END AS announced_points,
                   CASE WHEN l_returnflag <> 'R' THEN (count(*) - 1) // {PARTS} + 1 END AS announced_chunks
            FROM lineitem GROUP BY l_returnflag""",
    ),
    "throughput_by_concurrency": (
        concurrency,
        """WITH runs AS (
             SELECT o_orderkey, o_orderpriority AS tenant, o_orderdate AS begun, o_orderdate + to_microseconds(greatest(o_custkey * 60000000, 1)) AS ended,
               o_totalprice / nullif(o_custkey, 0)::DOUBLE AS throughput FROM orders),
           placed AS (
             SELECT a.o_orderkey, any_value(a.throughput) AS throughput, count(*) AS files_at_once, count(DISTINCT b.tenant) AS tenants_at_once
             FROM runs a JOIN runs b ON b.begun <= a.begun AND b.ended > a.begun GROUP BY a.o_orderkey)
           SELECT files_at_once, tenants_at_once, count(*) AS runs, round(avg(throughput), 3) AS mean_throughput FROM placed GROUP BY ALL""",
    ),
}
