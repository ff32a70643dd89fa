"""Queries over readings, silver, gold and topics, with their SQL twins."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from gaugeloft.functions.convert import convert_text, event_time_or_arrival, parse_json, to_message, utc_time
from gaugeloft.functions.measures import latency_seconds
from gaugeloft.functions.naming import in_key_sample
from gaugeloft.operators import gold as gold_ops
from gaugeloft.operators.latest import latest
from gaugeloft.operators.runs import ingest_counters, row_counts
from gaugeloft.operators.scoring import score
from gaugeloft.operators.secrecy import decrypt_fields, encrypt_fields, encrypt_payload
from gaugeloft.operators.silver import alert_rate, readings_from_messages, row_alerts, silver_text, window_average, within
from gaugeloft.plans.tables import file_count, naive, reading_messages, readings, staged_lines, staged_messages, table
from gaugeloft.schemas import parse_schema
from gaugeloft.session import fresh_dir, settle
from gaugeloft.sinks import keyed
from gaugeloft.sinks.messages import fan_out
from gaugeloft.sources.readings import read_readings_csv, rejected_lines, scan_lines
from gaugeloft.sources.topics import RAW_TOPIC, SILVER_TOPIC, as_envelope, first_messages, read_topic, replay, store_messages
from gaugeloft.streaming.pipelines import run_gold, run_gold_incremental, stored_topic

START, END = datetime(2024, 1, 5), datetime(2024, 1, 20)
LOW_FREQUENCY = 0.15
KNOWN_VM = 8

SQL_READINGS = "SELECT event_id, event_type AS tenant_id, user_id AS vm_id, ts AS event_time, value AS max_cpu FROM events"


def sql_silver(window: str, keys: str = "vm_id", rounded: bool = True) -> str:
    average = "round(avg(max_cpu), 6)" if rounded else "avg(max_cpu)"
    return f"""
        SELECT {keys}, window_start, window_start + INTERVAL '{window}' AS window_end,
               {average} AS avg_max_cpu, coalesce(avg(max_cpu) > 90, FALSE) AS is_window_anomaly
        FROM (SELECT *, time_bucket(INTERVAL '{window}', event_time) AS window_start FROM ({SQL_READINGS}))
        WHERE event_time IS NOT NULL GROUP BY {keys}, window_start"""


def sql_gold(silver: str, where: str = "TRUE", start: str = "NULL", end: str = "NULL", threshold: float = 0.8, key: str = "vm_id") -> str:
    return f"""
        SELECT {key} AS vm_id, CAST({start} AS TIMESTAMP) AS date_range_start, CAST({end} AS TIMESTAMP) AS date_range_end,
               count(*) AS total_windows, count(*) FILTER (WHERE is_window_anomaly) AS anomaly_windows,
               count(*) FILTER (WHERE is_window_anomaly) / count(*)::DOUBLE AS overload_frequency,
               CASE WHEN count(*) FILTER (WHERE is_window_anomaly) / count(*)::DOUBLE >= {threshold}
                    THEN 'Upgrade to higher CPU capacity' ELSE 'Current configuration is adequate' END AS recommendation
        FROM ({silver}) WHERE {where} GROUP BY ALL"""


def rounded(silver: DataFrame) -> DataFrame:
    return naive(silver.withColumn("avg_max_cpu", F.round("avg_max_cpu", 6)))


def silver(spark: SparkSession, sf_dir: str, window: str = "3 minutes") -> DataFrame:
    return window_average(readings(spark, sf_dir), window=window)


def silver_of_tenants(spark, sf_dir):
    return rounded(window_average(readings(spark, sf_dir), ["tenant_id", "vm_id"], window="5 minutes"))


def silver_as_text(spark, sf_dir):
    return silver_text(rounded(silver(spark, sf_dir, "1 hour")))


def silver_unique_readings(spark, sf_dir):
    doubled = readings(spark, sf_dir)
    doubled = doubled.unionByName(doubled)
    return rounded(window_average(doubled, window="1 day", unique_readings=True))


def gold(spark, sf_dir):
    return naive(gold_ops.overload(silver(spark, sf_dir)))


def _gold_between(spark, sf_dir, start: datetime, end: datetime) -> DataFrame:
    windows = window_average(within(readings(spark, sf_dir), start, end), window="1 hour")
    return naive(gold_ops.overload(windows, start, end))


def gold_in_range(spark, sf_dir):
    return _gold_between(spark, sf_dir, START, END)


def gold_lookback(spark, sf_dir):
    return _gold_between(spark, sf_dir, *gold_ops.lookback(24 * 7, as_of=datetime(2024, 1, 15)))


def gold_low_threshold(spark, sf_dir):
    return naive(gold_ops.overload(silver(spark, sf_dir), threshold=LOW_FREQUENCY))


def gold_incremental(spark, sf_dir):
    """The stored gold table brought up to date twice; the second run reads the days since the first."""
    silver_root, gold_root = fresh_dir(spark, "silver"), fresh_dir(spark, "gold")
    keyed.upsert_silver(silver(spark, sf_dir, "1 hour"), silver_root, 0)
    for run, until in enumerate((START, END)):
        run_gold_incremental(spark, silver_root, gold_root, run, until)
    return naive(keyed.read_gold(spark, gold_root).drop("processed_time"))


def gold_processed_time(spark, sf_dir):
    """Gold rows bear the time at which their run stored them."""
    root, begin = fresh_dir(spark, "gold"), datetime.now(timezone.utc)
    run_gold(silver(spark, sf_dir, "1 hour"), root, 0)
    end = datetime.now(timezone.utc)
    stored = keyed.read_gold(spark, root)
    return stored.select("vm_id", F.col("processed_time").between(utc_time(begin).cast("timestamp"), utc_time(end).cast("timestamp")).alias("stamped"))


def silver_quarantine(spark, sf_dir):
    """Windows whose key is missing are set aside when silver is stored."""
    root = fresh_dir(spark, "silver")
    keyed.upsert_silver(silver(spark, sf_dir, "1 day").withColumn("vm_id", F.nullif(F.col("vm_id"), F.lit(KNOWN_VM))), root, 0)
    return rounded(keyed.read_quarantine(spark, root).select("vm_id", "window_start", "window_end", "avg_max_cpu", "is_window_anomaly"))


def gold_corrected_windows(spark, sf_dir):
    """Silver that is corrected after it was counted: three versions, a run of gold after each, the last one backdated."""
    silver_root, gold_root = fresh_dir(spark, "silver"), fresh_dir(spark, "gold")
    rows = readings(spark, sf_dir)
    final = window_average(rows, window="1 hour")
    early = window_average(rows.filter(F.col("event_id") % 2 == 0), window="1 hour")
    versions = [early, final.filter(F.col("vm_id") % 3 == 0), final.filter(F.col("vm_id") % 3 != 0)]
    for run, (version, until) in enumerate(zip(versions, (START, END, datetime(2024, 1, 8)), strict=True)):
        keyed.upsert_silver(version, silver_root, run)
        run_gold_incremental(spark, silver_root, gold_root, run, until)
    return naive(keyed.read_gold(spark, gold_root).drop("processed_time"))


def gold_report(spark, sf_dir):
    return gold_ops.report(gold_ops.overload(silver(spark, sf_dir))).select("vm_id", "overload_frequency")


def _two_versions(spark, sf_dir) -> DataFrame:
    """A silver topic in which an early version of each window is followed by the final one."""
    rows = readings(spark, sf_dir).withColumn("vm_id", F.col("vm_id").cast("string"))
    early = window_average(rows.filter(F.col("event_id") % 2 == 0), window="1 day")
    final = window_average(rows, window="1 day")
    first, second = (to_message(silver_text(df), "vm_id") for df in (early, final))
    return as_envelope(first.unionByName(second), SILVER_TOPIC)


def gold_from_topic(spark, sf_dir):
    return naive(gold_ops.overload(gold_ops.silver_from_messages(_two_versions(spark, sf_dir))))


def gold_from_all_messages(spark, sf_dir):
    return naive(gold_ops.overload(gold_ops.silver_from_messages(_two_versions(spark, sf_dir), dedup=False)))


def latest_reading(spark, sf_dir):
    rows = readings(spark, sf_dir).select("vm_id", F.date_trunc("hour", "event_time").alias("window_start"), "event_id", "max_cpu")
    return naive(latest(rows, ["vm_id", "window_start"], ["event_id"]))


def latest_wide_reading(spark, sf_dir):
    rows = readings(spark, sf_dir)
    return latest(rows, ["vm_id"], ["event_time", "event_id"])


def key_sample(spark, sf_dir):
    return readings(spark, sf_dir).filter(in_key_sample(F.col("vm_id"), 10)).select("event_id", "vm_id")


def typed_conversion(spark, sf_dir):
    suffix = F.when(F.col("event_id") % 5 == 0, "x").when(F.col("event_id") % 7 == 0, "d").otherwise("")
    rows = table(spark, sf_dir, "events").withColumn("text", F.concat(F.col("value").cast("string"), suffix))
    return rows.select(
        "event_id",
        convert_text(F.col("text"), LongType()).alias("as_long"),
        convert_text(F.col("text"), DoubleType()).alias("as_double"),
        convert_text(F.col("props"), LongType()).alias("props_as_long"),
        convert_text(F.nullif(F.col("event_type"), F.lit("view")), StringType()).alias("as_string"),
    )


def json_parse(spark, sf_dir):
    schema = parse_schema('{"fields": [{"name": "k", "type": "long"}, {"name": "absent", "type": "string"}]}')
    return parse_json(table(spark, sf_dir, "events"), "props", schema, keep=["event_id"])


def raw_topic(spark, sf_dir):
    parsed = readings_from_messages(reading_messages(spark, sf_dir))
    return naive(parsed.select("timestamp", "vm_id", "min_cpu", "max_cpu", "adjusted_timestamp", "event_time", "is_anomaly"))


def keyed_json(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    fields = [{"name": "c_custkey", "type": "long"}, {"name": "c_name", "type": "string"}, {"name": "c_acctbal", "type": "double"}]
    return parse_json(to_message(customers, "c_nationkey"), "value", parse_schema(json.dumps({"fields": fields})), keep=["key"])


def topic_store(spark, sf_dir):
    path = fresh_dir(spark, "silver-topic")
    rows = silver(spark, sf_dir, "1 hour").withColumn("vm_id", F.col("vm_id").cast("string"))
    store_messages(to_message(silver_text(rows), "vm_id"), SILVER_TOPIC, path, 0)
    return rounded(gold_ops.silver_from_messages(read_topic(spark, SILVER_TOPIC, "parquet", path)))


def topic_replay(spark, sf_dir):
    stored = staged_messages(spark, sf_dir, file_count(spark))
    again = as_envelope(replay(read_topic(spark, RAW_TOPIC, "parquet", stored), RAW_TOPIC), "replayed")
    parsed = readings_from_messages(again).groupBy("vm_id")
    return parsed.agg(F.count("*").alias("readings"), F.max("max_cpu").alias("highest"))


def topic_peek(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit("").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
    schema = parse_schema('{"fields": [{"name": "k", "type": "long"}]}')
    return parse_json(first_messages(rows), "value", schema, keep=["topic", "partition", "offset"])


def time_fallback(spark, sf_dir):
    """Every third reading has no time of its own and takes the time it arrived."""
    rows = readings(spark, sf_dir)
    own = F.when(F.col("event_id") % 3 != 0, F.col("event_time"))
    arrival = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    return rounded(window_average(rows.withColumn("event_time", event_time_or_arrival(own, arrival)), window="1 day"))


def alerts(spark, sf_dir):
    return naive(row_alerts(readings(spark, sf_dir)))


def alert_rates(spark, sf_dir):
    return naive(alert_rate(readings(spark, sf_dir), "1 hour", 0.25))


def vm_lookup(spark, sf_dir):
    return rounded(gold_ops.windows_of(silver(spark, sf_dir), KNOWN_VM, START, END))


def preview_100(spark, sf_dir):
    return rounded(gold_ops.preview(silver(spark, sf_dir, "1 hour")))


def newest_first(spark, sf_dir):
    return rounded(gold_ops.newest_first(silver(spark, sf_dir, "1 day")))


def silver_table(spark, sf_dir):
    """An early version of the table, the same batch replayed, the table rewritten, then the final version."""
    root, rewritten = fresh_dir(spark, "silver"), fresh_dir(spark, "silver")
    rows = readings(spark, sf_dir)
    early = window_average(rows.filter(F.col("event_id") % 2 == 0), window="1 hour")
    keyed.upsert_silver(early, root, 0)
    keyed.upsert_silver(early, root, 0)
    keyed.rewrite_silver(spark, root, rewritten)
    keyed.upsert_silver(window_average(rows, window="1 hour"), rewritten, 1)
    return rounded(keyed.read_silver(spark, rewritten).drop("date"))


def vm_lookup_stored(spark, sf_dir):
    """Windows of one VM from the stored table, which was written in two versions and rewritten for lookups."""
    root, rewritten = fresh_dir(spark, "silver"), fresh_dir(spark, "silver")
    rows = readings(spark, sf_dir)
    for version, part in enumerate((rows.filter(F.col("event_id") % 2 == 0), rows)):
        keyed.upsert_silver(window_average(part), root, version)
    keyed.rewrite_silver(spark, root, rewritten)
    return rounded(gold_ops.windows_of(keyed.read_silver(spark, rewritten), KNOWN_VM, START, END).drop("date"))


def gold_table(spark, sf_dir):
    root = fresh_dir(spark, "gold")
    keyed.upsert_gold(gold_ops.overload(silver(spark, sf_dir, "1 hour"), START, END), root, 0)
    keyed.upsert_gold(gold_ops.overload(silver(spark, sf_dir)), root, 1)
    return naive(keyed.read_gold(spark, root))


def fan_out_counts(spark, sf_dir):
    root, topic = fresh_dir(spark, "fan-silver"), fresh_dir(spark, "fan-topic")
    rows = silver(spark, sf_dir, "1 hour")
    fan_out(
        rows,
        [
            lambda df: keyed.upsert_silver(df, root, 0),
            lambda df: store_messages(to_message(silver_text(df), "vm_id"), SILVER_TOPIC, topic, 0),
        ],
    )
    stores = {"table": keyed.read_silver(spark, root), "topic": read_topic(spark, SILVER_TOPIC, "parquet", topic)}
    return row_counts(stores)


def table_counts(spark, sf_dir):
    return row_counts({n: table(spark, sf_dir, n) for n in ("events", "lineitem", "orders")})


def _lines(spark, sf_dir, modulus=None) -> DataFrame:
    return scan_lines(spark, [f"{staged_lines(spark, sf_dir)}/tenant=*"], glob="*.txt", modulus=modulus)


def csv_readings(spark, sf_dir):
    return read_readings_csv(spark, [f"{staged_lines(spark, sf_dir)}/tenant=*"], glob="*.txt")


def csv_to_silver(spark, sf_dir):
    """CSV lines to the raw topic, and from there to silver."""
    path = fresh_dir(spark, "raw-topic")
    stored_topic(path, RAW_TOPIC)(csv_readings(spark, sf_dir), 0)
    published = readings_from_messages(read_topic(spark, RAW_TOPIC, "parquet", path))
    return rounded(window_average(published))


def csv_rejected(spark, sf_dir):
    rejected = rejected_lines(_lines(spark, sf_dir))
    return rejected.groupBy("tenant_id", "reason").agg(F.count("*").alias("lines"))


def csv_counters(spark, sf_dir):
    return ingest_counters(_lines(spark, sf_dir, modulus=10), ["tenant_id"])


def _tenant_keys(spark, sf_dir) -> DataFrame:
    tenants = table(spark, sf_dir, "events").select(F.col("event_type").alias("tenant_id")).distinct()
    return tenants.withColumn("key", F.unhex(F.md5("tenant_id")))


def encrypted_fields(spark, sf_dir):
    rows, keys = readings(spark, sf_dir), _tenant_keys(spark, sf_dir)
    sealed = encrypt_fields(rows, keys, ["max_cpu"]).withColumn("sealed", F.col("max_cpu"))
    opened = decrypt_fields(sealed, keys, {"max_cpu": "double"})
    hidden = F.coalesce(F.col("sealed") != F.col("max_cpu").cast("string"), F.col("sealed").isNull())
    return opened.select("event_id", "tenant_id", "max_cpu", hidden.alias("is_hidden"))


def encrypted_payload(spark, sf_dir):
    rows, keys = readings(spark, sf_dir).select("event_id", "tenant_id", "vm_id"), _tenant_keys(spark, sf_dir)
    opened = decrypt_fields(encrypt_payload(rows, keys), keys, {"payload": "string"})
    schema = parse_schema('{"fields": [{"name": "event_id", "type": "long"}, {"name": "vm_id", "type": "long"}]}')
    return parse_json(opened, "payload", schema, keep=["tenant_id"])


def _share_of_capacity(payloads: list[str]) -> list[float]:
    return [json.loads(p)["avg_max_cpu"] / 100 for p in payloads]


def scored_silver(spark, sf_dir):
    return score(rounded(silver(spark, sf_dir, "1 hour")), _share_of_capacity).select("vm_id", "window_start", F.round("score", 6).alias("score"))


def message_latency(spark, sf_dir):
    late = latency_seconds(F.col("ts"), utc_time(datetime(2024, 2, 1)))
    return table(spark, sf_dir, "events").select("event_id", F.round(late, 3).alias("latency_sec"))


H = "('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT"
SQL_LINES = f"""
    SELECT *, 'tenant=' || event_type AS tenant_id, {H} % 100 < 20 AS faulty, ({H} // 100) % 3 AS kind,
           ('0x' || substr(md5('vm' || user_id), 1, 8))::BIGINT % 10 = 0 AS sampled
    FROM events"""
TEXT = "(value::VARCHAR || CASE WHEN event_id % 5 = 0 THEN 'x' WHEN event_id % 7 = 0 THEN 'd' ELSE '' END)"
NUMBER = f"CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE TRY_CAST({TEXT} AS DOUBLE) END"
RANGE = "window_start >= TIMESTAMP '2024-01-05' AND window_end <= TIMESTAMP '2024-01-20'"

EARLY = sql_silver("1 day", rounded=False).replace("FROM events", "FROM events WHERE event_id % 2 = 0")

QUERIES = {
    "silver_3m": (lambda s, d: rounded(silver(s, d)), sql_silver("3 minutes")),
    "silver_1h": (lambda s, d: rounded(silver(s, d, "1 hour")), sql_silver("1 hour")),
    "silver_1d": (lambda s, d: rounded(silver(s, d, "1 day")), sql_silver("1 day")),
    "silver_by_tenant": (silver_of_tenants, sql_silver("5 minutes", "tenant_id, vm_id")),
    "silver_text": (
        silver_as_text,
        f"""SELECT vm_id, window_start::VARCHAR AS window_start, window_end::VARCHAR AS window_end, avg_max_cpu,
                   is_window_anomaly FROM ({sql_silver("1 hour")})""",
    ),
    "silver_unique_readings": (silver_unique_readings, sql_silver("1 day")),
    "gold_all": (gold, sql_gold(sql_silver("3 minutes", rounded=False))),
    "gold_range": (
        gold_in_range,
        sql_gold(sql_silver("1 hour", rounded=False), RANGE, "'2024-01-05'", "'2024-01-20'"),
    ),
    "gold_lookback": (
        gold_lookback,
        sql_gold(
            sql_silver("1 hour", rounded=False),
            "window_start >= TIMESTAMP '2024-01-08' AND window_end <= TIMESTAMP '2024-01-15'",
            "'2024-01-08'",
            "'2024-01-15'",
        ),
    ),
    "gold_at_low_threshold": (gold_low_threshold, sql_gold(sql_silver("3 minutes", rounded=False), threshold=LOW_FREQUENCY)),
    "gold_incremental": (
        gold_incremental,
        sql_gold(sql_silver("1 hour", rounded=False), "window_end <= TIMESTAMP '2024-01-20'", end="TIMESTAMP '2024-01-20'"),
    ),
    "gold_processed_time": (gold_processed_time, "SELECT DISTINCT user_id AS vm_id, TRUE AS stamped FROM events WHERE ts IS NOT NULL"),
    "silver_quarantine": (silver_quarantine, f"SELECT * REPLACE (NULL::BIGINT AS vm_id) FROM ({sql_silver('1 day')}) WHERE vm_id = {KNOWN_VM}"),
    "gold_corrected_windows": (
        gold_corrected_windows,
        sql_gold(sql_silver("1 hour", rounded=False), "window_end <= TIMESTAMP '2024-01-20'", end="TIMESTAMP '2024-01-20'"),
    ),
    "gold_report": (
        gold_report,
        f"SELECT vm_id, printf('%.2f%%', overload_frequency * 100) AS overload_frequency FROM ({sql_gold(sql_silver('3 minutes', rounded=False))})",
    ),
    "gold_from_topic": (gold_from_topic, sql_gold(sql_silver("1 day", rounded=False), key="vm_id::VARCHAR")),
    "gold_from_all_messages": (
        gold_from_all_messages,
        sql_gold(f"({EARLY}) UNION ALL ({sql_silver('1 day', rounded=False)})", key="vm_id::VARCHAR"),
    ),
    "silver_versions_latest": (
        latest_reading,
        """SELECT user_id AS vm_id, date_trunc('hour', ts)::TIMESTAMP AS window_start, max(event_id) AS event_id,
                  arg_max(value, event_id) AS max_cpu FROM events GROUP BY 1, 2""",
    ),
    "reading_latest_wide": (
        latest_wide_reading,
        f"SELECT * FROM ({SQL_READINGS}) QUALIFY row_number() OVER (PARTITION BY vm_id ORDER BY event_time DESC, event_id DESC) = 1",
    ),
    "key_sample": (
        key_sample,
        "SELECT event_id, user_id AS vm_id FROM events WHERE ('0x' || substr(md5(user_id::VARCHAR), 1, 8))::BIGINT % 10 = 0",
    ),
    "typed_conversion": (
        typed_conversion,
        f"""SELECT event_id, coalesce(TRY_CAST(trunc({NUMBER}) AS BIGINT), 0) AS as_long, coalesce({NUMBER}, 0.0::DOUBLE) AS as_double,
                   0::BIGINT AS props_as_long, CASE WHEN event_type = 'view' THEN '' ELSE coalesce(event_type, '') END AS as_string
            FROM events""",
    ),
    "json_parse": (json_parse, "SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k, NULL::VARCHAR AS absent FROM events"),
    "raw_topic_parse": (
        raw_topic,
        """SELECT epoch(date_trunc('second', ts))::BIGINT - 1546300800 AS "timestamp", user_id::VARCHAR AS vm_id,
                  value / 2 AS min_cpu, value AS max_cpu, epoch(date_trunc('second', ts))::BIGINT AS adjusted_timestamp,
                  date_trunc('second', ts) AS event_time, coalesce(value > 90, FALSE) AS is_anomaly FROM events""",
    ),
    "keyed_json": (keyed_json, "SELECT c_nationkey::VARCHAR AS key, c_custkey, c_name, c_acctbal FROM customer"),
    "topic_store": (
        topic_store,
        f"SELECT * REPLACE (vm_id::VARCHAR AS vm_id) FROM ({sql_silver('1 hour')})",
    ),
    "topic_replay": (
        topic_replay,
        "SELECT user_id::VARCHAR AS vm_id, count(*) AS readings, max(value) AS highest FROM events GROUP BY 1",
    ),
    "topic_peek": (
        topic_peek,
        """SELECT event_type AS topic, (user_id % 3)::INTEGER AS partition, event_id AS "offset", CAST(props ->> 'k' AS BIGINT) AS k
           FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY user_id % 3, event_id) = 1""",
    ),
    "time_fallback": (
        time_fallback,
        sql_silver("1 day").replace(
            "ts AS event_time", "CASE WHEN event_id % 3 <> 0 THEN ts ELSE TIMESTAMP '2024-03-01 00:00:00' END AS event_time"
        ),
    ),
    "row_alerts": (
        alerts,
        'SELECT user_id AS vm_id, ts AS "timestamp", value AS max_cpu, TRUE AS is_anomaly FROM events WHERE value > 90',
    ),
    "alert_rate": (
        alert_rates,
        """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
                  count(*) AS readings, count(*) FILTER (WHERE value > 90) AS alerts,
                  count(*) FILTER (WHERE value > 90) / count(*)::DOUBLE AS alert_rate,
                  count(*) FILTER (WHERE value > 90) / count(*)::DOUBLE > 0.25 AS is_critical
           FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
    ),
    "vm_lookup": (
        vm_lookup,
        f"""SELECT * FROM ({sql_silver("3 minutes")}) WHERE vm_id = {KNOWN_VM}
            AND window_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""",
    ),
    "vm_lookup_stored": (
        vm_lookup_stored,
        f"""SELECT * FROM ({sql_silver("3 minutes")}) WHERE vm_id = {KNOWN_VM}
            AND window_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""",
    ),
    "preview_100": (preview_100, f"SELECT * FROM ({sql_silver('1 hour')}) ORDER BY vm_id, window_start DESC LIMIT 100"),
    "newest_first": (newest_first, f"SELECT * FROM ({sql_silver('1 day')}) ORDER BY vm_id, window_start DESC"),
    "silver_table": (silver_table, sql_silver("1 hour")),
    "gold_scan": (gold_table, sql_gold(sql_silver("3 minutes", rounded=False))),
    "fan_out": (
        fan_out_counts,
        f"""WITH s AS ({sql_silver("1 hour")}) SELECT 'table' AS table_name, count(*) AS row_count FROM s
            UNION ALL SELECT 'topic', count(*) FROM s""",
    ),
    "table_counts": (
        table_counts,
        """SELECT 'events' AS table_name, count(*) AS row_count FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem
           UNION ALL SELECT 'orders', count(*) FROM orders""",
    ),
    "csv_readings": (
        csv_readings,
        f"""SELECT tenant_id, event_id AS "timestamp", 'vm' || user_id AS vm_id, coalesce(value, 0.0) AS min_cpu,
                   coalesce(value, 0.0) AS max_cpu, CASE WHEN faulty AND kind = 1 THEN 0.0::DOUBLE ELSE coalesce(value, 0.0) END AS avg_cpu
            FROM ({SQL_LINES}) WHERE NOT (faulty AND kind = 0)""",
    ),
    "csv_to_silver": (
        csv_to_silver,
        f"""SELECT vm_id, window_start, window_start + INTERVAL '3 minutes' AS window_end, round(avg(max_cpu), 6) AS avg_max_cpu,
                   coalesce(avg(max_cpu) > 90, FALSE) AS is_window_anomaly
            FROM (SELECT 'vm' || user_id AS vm_id, coalesce(value, 0.0) AS max_cpu,
                         time_bucket(INTERVAL '3 minutes', TIMESTAMP '2019-01-01' + to_seconds(event_id)) AS window_start
                  FROM ({SQL_LINES}) WHERE NOT (faulty AND kind = 0)) GROUP BY vm_id, window_start""",
    ),
    "csv_rejected": (
        csv_rejected,
        f"""SELECT tenant_id, CASE WHEN kind = 0 THEN 'too few fields' ELSE 'bad avg_cpu' END AS reason, count(*) AS lines
            FROM ({SQL_LINES}) WHERE faulty AND kind < 2 GROUP BY ALL""",
    ),
    "ingest_counters": (
        csv_counters,
        f"""SELECT tenant_id, count(*) AS lines, count(*) FILTER (WHERE ok AND sampled) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid,
                   count(*) FILTER (WHERE ok AND NOT sampled) AS filtered, count(*) FILTER (WHERE ok AND sampled) AS sent
            FROM (SELECT *, NOT (faulty AND kind = 0) AS ok FROM ({SQL_LINES})) GROUP BY tenant_id""",
    ),
    "encrypted_fields": (
        encrypted_fields,
        "SELECT event_id, event_type AS tenant_id, value AS max_cpu, TRUE AS is_hidden FROM events",
    ),
    "encrypted_payload": (encrypted_payload, "SELECT event_type AS tenant_id, event_id, user_id AS vm_id FROM events"),
    "scored_silver": (
        scored_silver,
        f"SELECT vm_id, window_start, round(avg_max_cpu / 100, 6) AS score FROM ({sql_silver('1 hour')})",
    ),
    "message_latency": (
        message_latency,
        "SELECT event_id, round((epoch_us(TIMESTAMP '2024-02-01') / 1e6) - (epoch_us(ts) / 1e6), 3) AS latency_sec FROM events",
    ),
}

