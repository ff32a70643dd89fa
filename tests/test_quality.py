import json

import pytest
from pyspark.sql import functions as F

from gaugeloft.operators import quality
from gaugeloft.operators.scoring import score
from gaugeloft.operators.secrecy import decrypt_fields, encrypt_fields, encrypt_payload
from gaugeloft.schemas import READINGS


def test_drift_stops_a_batch_above_the_limit(spark):
    df = spark.range(10).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), F.when(F.col("id") > 1, F.col("id")).alias("b"))
    quality.stop_on_drift(df, ["a"])
    with pytest.raises(quality.SchemaDrift, match="b: 2 of 10"):
        quality.stop_on_drift(df, ["a", "b"])
    quality.stop_on_drift(df.limit(0), ["a", "b"])


def test_schema_validation(spark):
    texts = ['{"timestamp": 1, "vm_id": "a", "max_cpu": 2.5}', '{"timestamp": "x", "vm_id": "a"}', "garbage"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r.i: r._errors for r in quality.validate_messages(df, "value", READINGS, ["timestamp", "vm_id", "max_cpu"]).collect()}
    assert got == {0: [], 1: ["wrong type timestamp", "missing max_cpu"], 2: ["missing timestamp", "missing vm_id", "missing max_cpu"]}


def test_ranges(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (-1, 50.0), (9, 10.0)], "a int, b double")
    checked = quality.range_errors(df, {"a": (0, 8), "b": (None, 10.0)})
    assert {r.a: r._out_of_range for r in checked.collect()} == {1: [], 2: [], -1: ["a", "b"], 9: ["a"]}
    good, bad = quality.split_by(checked, "_out_of_range")
    assert (good.count(), bad.count()) == (2, 2)


def test_completeness(spark):
    df = spark.createDataFrame([("f", 1, 2), ("f", None, 2), ("g", 1, 1)], "file string, X int, Y int")
    got = {r.file: (r.rows, r.complete_rows, r.is_complete) for r in quality.completeness_by(df, ["file"], ["X", "Y"]).collect()}
    assert got == {"f": (2, 1, False), "g": (1, 1, True)}
    assert quality.completeness(df, ["X", "Z"]).first()._missing == ["Z"]


def test_outliers(spark):
    rows = [("a", float(v)) for v in [1] * 50 + [100]] + [("b", 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    far = quality.outliers_by_deviation(df, ["g"], "v", 3.0)
    assert [r.v for r in far.filter("is_outlier").collect()] == [100.0] and far.count() == len(rows)
    odd = quality.outliers_by_percentile(df, ["g"], "v", 0.0, 0.98)
    assert [r.v for r in odd.filter("is_outlier").collect()] == [100.0] and odd.count() == len(rows)


def test_alerts_name_the_rates_above_their_limits(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", None, None), ("b", 2, False)], "g string, v int, odd boolean")
    flags = {"missing": F.col("v").isNull(), "odd": F.col("odd")}
    got = {r.g: (r.missing_rate, r.alerts) for r in quality.quality_alerts(df, ["g"], flags, {"missing": 0.4, "odd": 0.5}).collect()}
    assert got == {"a": (0.5, ["missing"]), "b": (0.0, [])}


def test_fields_are_encrypted_per_tenant(spark):
    df = spark.createDataFrame([("t1", 1.5, "n"), ("t2", 1.5, "n"), ("t3", 1.5, "n"), ("t1", None, "n")], "tenant_id string, X double, note string")
    keys = spark.createDataFrame([("t1", b"0123456789abcdef"), ("t2", b"fedcba9876543210")], "tenant_id string, key binary")
    sealed = encrypt_fields(df, keys, ["X"])
    values = {(r.tenant_id, r.X) for r in sealed.collect()}
    assert ("t3", None) in values and not any(x == "1.5" for _, x in values)
    opened = decrypt_fields(sealed, keys, {"X": "double"})
    assert sorted((r.tenant_id, str(r.X)) for r in opened.collect()) == [("t1", "1.5"), ("t1", "None"), ("t2", "1.5"), ("t3", "None")]
    swapped = keys.select("tenant_id", F.when(F.col("tenant_id") == "t1", F.lit(b"fedcba9876543210")).otherwise(F.col("key")).alias("key"))
    with pytest.raises(Exception, match="AES"):
        decrypt_fields(sealed, swapped, {"X": "double"}).collect()


def test_payload_is_one_encrypted_text(spark):
    df = spark.createDataFrame([("t1", 1)], "tenant_id string, n int")
    keys = spark.createDataFrame([("t1", b"0123456789abcdef")], "tenant_id string, key binary")
    sealed = encrypt_payload(df, keys)
    assert sealed.columns == ["tenant_id", "payload"] and "n" not in sealed.first().payload.split()
    assert json.loads(decrypt_fields(sealed, keys, {"payload": "string"}).first().payload) == {"tenant_id": "t1", "n": 1}


def test_scorer_sees_json_and_runs_in_the_tasks(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", None)], "vm_id string, avg_max_cpu double")
    got = score(df, lambda texts: [json.loads(t).get("avg_max_cpu", -1.0) * 2 for t in texts])
    assert sorted(map(tuple, got.select("vm_id", "score").collect())) == [("a", 100.0), ("b", -2.0)]


def test_outliers_without_a_group(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(100), 10_000]], "v double")
    for flagged in (quality.outliers_by_deviation(df, [], "v", 3.0), quality.outliers_by_percentile(df, [], "v", 0.0, 0.99)):
        assert [r.v for r in flagged.filter("is_outlier").collect()] == [10_000.0]
