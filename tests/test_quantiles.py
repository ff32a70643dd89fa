"""Running percentiles, outliers and failure templates, against plain Python."""

import random
import re
from collections import Counter

import numpy as np
from gaugeloft.operators.runs import failure_templates
from gaugeloft.sinks import keyed
from gaugeloft.streaming.quantiles import RANK_ERROR, quantiles_of, read_quantiles, run_outliers, sketches


def test_merged_sketches_are_within_the_stated_error(spark):
    rng = random.Random(1)
    values = {"a": [rng.lognormvariate(0, 2) for _ in range(30_000)], "b": [float(rng.randrange(5)) for _ in range(400)], "c": [7.0]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("a", None), ("b", float("nan"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    parts = [sketches(df.filter(f"abs(hash(v)) % 6 = {i}"), ["g"], "v") for i in range(6)]
    stored = parts[0]
    for part in parts[1:]:
        stored = stored.unionByName(part)
    fractions = {f"p{i}": i / 100 for i in (1, 25, 50, 75, 99)}
    for r in quantiles_of(stored, ["g"], fractions).collect():
        held = np.sort(values[r["g"]])
        assert r["n"] == len(held)
        for name, f in fractions.items():
            low, high = (np.searchsorted(held, r[name], side) / len(held) for side in ("left", "right"))
            assert low - max(RANK_ERROR, 1 / len(held)) <= f <= high + max(RANK_ERROR, 1 / len(held))


def test_a_batch_is_judged_by_those_before_it(spark, path):
    schema = "g string, at long, v double"
    batches = [[("a", i, float(i)) for i in range(100)], [("a", 100, 50.0), ("a", 101, 900.0), ("a", 102, -5.0), ("b", 103, 1e6), (None, 104, 1e9)], [("b", 105, 2e6), ("b", 106, 1e6)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    run_outliers(stream, f"{path}/sketches", f"{path}/outliers", f"{path}/check", ["g"], "v", bounded=True).awaitTermination()
    found = keyed.read_versions(spark, f"{path}/outliers")
    assert sorted((r["at"], r["batch_id"]) for r in found.collect()) == [(101, 1), (102, 1), (105, 2)]
    assert {r["g"]: r["n"] for r in read_quantiles(spark, f"{path}/sketches", ["g"], {"p50": 0.5}).collect()} == {"a": 103, "b": 3}
    assert {r["g"]: r["n"] for r in read_quantiles(spark, f"{path}/sketches", ["g"], {"p50": 0.5}, before=1).collect()} == {"a": 100}


def brute_templates(logs, most):
    value = re.compile(r"[0-9/\\\\@]|[^.=][.=][^.=]")
    each = [(t, e) for t, errors in logs for e in (errors or [None])]
    words = {e: tuple("*" if value.search(w) else w for w in e.split()) for _, e in each if e is not None}
    seen = {}
    for w in words.values():
        for i, x in enumerate(w):
            seen.setdefault((len(w), w[0], i), set()).add(x)
    out = Counter()
    for tenant, e in each:
        w = words.get(e)
        out[tenant, None if w is None else " ".join("*" if len(seen[len(w), w[0], i]) > most else x for i, x in enumerate(w))] += 1
    return out


def test_templates_by_brute_force(spark):
    rng = random.Random(4)
    names = ["ann", "bob", "cyd", "dan", "eve", "fay", "gus", "hal", "ivy", "jon"]
    def message():
        return rng.choice([
            f"user {rng.choice(names)} has no access", f"disk /dev/sd{rng.choice('abc')} is {rng.choice(['full', 'slow'])}", f"host db{rng.randrange(9)}.example.org did not answer",
            f"timeout  after {rng.randrange(99)} s", f"key=a{rng.randrange(5)} unknown", "out of memory", f"id {rng.getrandbits(64):x} is twice there",
        ])
    logs = [(rng.choice("AB"), [message() for _ in range(rng.randrange(4))]) for _ in range(300)] + [("A", None), ("C", [])]
    df = spark.createDataFrame(logs, "tenant_id string, errors array<string>")
    found = {(r["tenant_id"], r["template"]): r["occurrences"] for r in failure_templates(df).collect()}
    assert found == brute_templates(logs, 8)
    assert {"user * has no access", "disk * is full", "disk * is slow", "host * did not answer", "timeout after * s", "out of memory", None} <= {t for _, t in found}
    assert failure_templates(df.limit(0)).collect() == []
