import json
import math
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from gaugeloft import schemas
from gaugeloft.functions import convert, measures, naming


def values(df):
    return [r[0] for r in df.collect()]


def expected(text, kind):
    """The conversion rule in plain Python."""
    try:
        if kind == "long":
            return int(float(text))
        return float(text) if kind == "double" else str(text)
    except (TypeError, ValueError, OverflowError):
        return {"long": 0, "double": 0.0}[kind]


TEXTS = ["12.9", "-3.99", "abc", "", " 7 ", "1e3", "1d", "2F", "0x10", "inf", "-Infinity", "nan", "12abc", "5."]


@pytest.mark.parametrize("kind,spark_type", [("long", LongType()), ("double", DoubleType())])
def test_conversion_follows_the_default_rule(spark, kind, spark_type):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").orderBy("i")
    got = values(df.select(convert.convert_text(F.col("t"), spark_type)))
    for text, value in zip(TEXTS, got):
        want = expected(text, kind)
        assert value == want or (math.isnan(value) and math.isnan(want)), text


def test_conversion_of_null_and_null_mode(spark):
    df = spark.createDataFrame([(None,), ("x",)], "t string")
    assert values(df.select(convert.convert_text(F.col("t"), StringType()))) == ["", "x"]
    assert values(df.select(convert.convert_text(F.col("t"), LongType()))) == [0, 0]
    assert values(df.select(convert.convert_text(F.col("t"), LongType(), "null"))) == [None, None]


def test_json_that_does_not_fit_is_null(spark):
    texts = ['{"timestamp": 5, "vm_id": "a", "max_cpu": 91.5, "other": 1}', '{"timestamp": "x", "vm_id": "b"}', "garbage", '{"max_cpu": "91.5"}']
    df = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    rows = convert.parse_json(df, "value", schemas.READINGS).collect()
    assert (rows[0].timestamp, rows[0].vm_id, rows[0].max_cpu) == (5, "a", 91.5)
    assert (rows[1].timestamp, rows[1].vm_id) == (None, "b")
    assert all(v is None for v in rows[2])
    assert rows[3].max_cpu is None


def test_times(spark):
    df = spark.createDataFrame([(60, "2019-01-01 00:01:00"), (None, "soon")], "s bigint, t string")
    rows = df.select(
        convert.epoch_to_time(convert.shift_epoch(F.col("s"))).alias("a"),
        convert.text_to_time(F.col("t")).alias("b"),
        convert.time_to_text(convert.text_to_time(F.col("t"))).alias("c"),
    ).collect()
    assert rows[0].a == rows[0].b == datetime(2019, 1, 1, 0, 1) and rows[0].c == "2019-01-01 00:01:00"
    assert rows[1].a is None and rows[1].b is None


def test_event_time_falls_back_on_arrival(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS e, TIMESTAMP '2024-01-01 00:00:00' AS a")
    assert values(df.select(convert.event_time_or_arrival(F.col("e"), F.col("a")))) == [datetime(2024, 1, 1)]


def test_paths(spark):
    paths = ["/data/tenantB/x.las", "/data/other/a.b.c.las", "tenantA/tenantC/f", "file.las"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert values(df.select(naming.tenant_of(F.col("p")))) == ["tenantB", "tenantA", "tenantA", "tenantA"]
    assert values(df.select(naming.file_name_of(F.col("p")))) == ["x.las", "a.b.c.las", "f", "file.las"]
    assert values(df.select(naming.stem_of(F.col("p")))) == ["x", "a", "f", "file"]


def test_ids_are_name_based_uuids(spark):
    names = [("tenantA", "sample_file.las"), ("tenantB", "übung.las"), ("", "")] + [("t", str(i)) for i in range(64)]
    df = spark.createDataFrame(names, "t string, f string")
    got = values(df.select(naming.file_id(F.col("t"), F.col("f"))))
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{t}:{f}")) for t, f in names]


def test_key_sample_keeps_whole_keys_and_about_one_in_n(spark):
    df = spark.range(20000).select((F.col("id") % 2000).cast("string").alias("k"))
    kept = df.filter(naming.in_key_sample(F.col("k"), 10)).groupBy("k").count().collect()
    assert all(r["count"] == 10 for r in kept) and 120 < len(kept) < 280


def test_flags_and_labels_at_the_boundary(spark):
    df = spark.createDataFrame([(90.0,), (90.0001,), (None,), (float("nan"),)], "v double")
    assert values(df.select(measures.is_over(F.col("v")))) == [False, True, False, True]
    ratios = spark.createDataFrame([(0.8,), (0.7999,), (1.0,), (0.0,)], "r double")
    labels = values(ratios.select(measures.recommendation(F.col("r"))))
    assert labels == [measures.UPGRADE, measures.ADEQUATE, measures.UPGRADE, measures.ADEQUATE]


def test_run_measures(spark):
    df = spark.createDataFrame([(30.0, 16.83, 550000), (30.0, 0.0, 0)], "s double, t double, n bigint")
    rows = df.select(
        measures.throughput(F.col("s"), F.col("t")).alias("rate"),
        measures.run_status(F.col("n")).alias("status"),
        measures.estimated_mb(F.col("n")).alias("mb"),
    ).collect()
    assert [(r.rate, r.status) for r in rows] == [(1.78, "success"), (0.0, "error")]
    assert rows[0].mb == 550000 * 24 * 8 / (1024 * 1024)


@pytest.mark.parametrize("ratio", [0.0, 1.0, 0.15625, 0.46875, 1 / 3, 0.125, 0.8, 0.02675, 0.00005, 0.00015, 0.99995, 0.12345, 0.56785, 2 / 3])
def test_percent_text(spark, ratio):
    df = spark.createDataFrame([(ratio,)], "r double")
    assert values(df.select(measures.percent_text(F.col("r")))) == [f"{ratio * 100:.2f}%"]


def test_schema_from_json(tmp_path):
    fields = [{"name": "timestamp", "type": "long"}, {"name": "vm_id", "type": "string", "nullable": False}]
    good = tmp_path / "schema.json"
    good.write_text(json.dumps({"type": "struct", "fields": fields, "data_dirs": ["a"]}))
    loaded = schemas.load_schema(str(good))
    assert [(f.name, f.dataType, f.nullable) for f in loaded] == [("timestamp", LongType(), True), ("vm_id", StringType(), False)]


@pytest.mark.parametrize("text", [None, "not json", '{"fields": [{"name": "a", "type": "nonsense"}]}'])
def test_schema_falls_back(tmp_path, text):
    file = tmp_path / "schema.json"
    if text is not None:
        file.write_text(text)
    assert schemas.load_schema(str(file)) == schemas.READINGS
    assert isinstance(schemas.SILVER_MESSAGE, StructType)
