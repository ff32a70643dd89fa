import math

import numpy as np
from gaugeloft.llm.queries import op2_exact_topk
from gaugeloft.llm.topk import LEVELS, nearest, segment_features
from pyspark.sql import functions as F

from tests_support import against_sql

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    """Scores of all pairs; the rules for odd vectors as stated."""
    fit = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in fit:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in fit if c != q and len(y) == len(x))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=5, block=64):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, nearest(df, F.col("vec_id") % 50 == 0, k, block=block).collect()))


def test_random_and_clustered_vectors(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 24))
    rows = [(i, (centres[i % 6] + r.normal(size=24) * 0.2).astype("float32").tolist()) for i in range(330)]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, rows[:40], k=60, block=7) == brute(rows[:40], 60)


def test_ties_copies_and_odd_vectors(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(120)] + [(200, None), (250, []), (300, [1.0, None, 0.0]), (350, [1.0, float("nan"), 0.0]), (400, [float("inf"), 0.0, 0.0]), (None, same), (450, [1.0, 2.0]), (451, [2.0, 1.0])]
    assert run(spark, rows) == brute(rows, 5)


def test_huge_components_are_cut_to_a_long(spark):
    rows = [(0, [3e38, 0.0]), (1, [3e38, 1.0]), (2, [-3e38, 1.0])]
    assert run(spark, rows) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_repeated_rows_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    assert run(spark, rows) == sorted([(0, 1, 7, 65536), (0, 2, 7, 65536)] * 2)
    assert run(spark, []) == []


def test_bounds_hold():
    r = np.random.default_rng(5)
    x, y = r.normal(size=(50, 37)), r.normal(size=(60, 37))
    exact, last = x @ y.T, None
    for level in LEVELS:
        bound = segment_features(x, level) @ segment_features(y, level).T
        assert (bound >= exact - 1e-9).all()
        assert last is None or (bound - exact).mean() < (last - exact).mean()
        last = bound


def test_query_equals_sql(spark):
    against_sql(spark, op2_exact_topk, "op2_exact_topk")
