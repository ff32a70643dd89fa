from collections import Counter

import numpy as np
import pytest
from gaugeloft.llm import mixing
from gaugeloft.llm.mixing import LANGUAGES, OTHER, TOPICS, Margins, Raked, cap, count_words, mix, rake, source_factors, within_supply
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def shares(rows, key, weight):
    out = Counter()
    for r in rows:
        out[key(r)] += weight(r) * r["n_tokens"]
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def tempered(observed, power):
    raised = {k: v**power for k, v in observed.items()}
    return {k: v / sum(raised.values()) for k, v in raised.items()}


def test_margins_are_met_and_the_sample_follows(table):
    rows = mix(table("documents"), margins=Margins(source=0.5, language={"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}, topic=0.5)).collect()
    one = lambda r: 1.0
    for key, aim in ((lambda r: r["source"], 0.5), (lambda r: r["topic"], 0.5)):
        want = tempered(shares(rows, key, one), aim)
        got = shares(rows, key, lambda r: r["weight"])
        assert got == pytest.approx(want, abs=1e-6)
    assert shares(rows, lambda r: r["lang"], lambda r: r["probability"]) == pytest.approx({"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}, abs=1e-6)
    assert max(r["probability"] for r in rows) == pytest.approx(1.0)
    expected = sum(r["probability"] for r in rows)
    assert abs(sum(r["kept"] for r in rows) - expected) < 4 * expected**0.5
    assert np.average([r["weight"] for r in rows], weights=[r["n_tokens"] for r in rows]) == pytest.approx(1.0)


def brute(cells, margins, rounds=3000):
    """Plain raking of all cells, one margin after another."""
    keys = [lambda c: c[0], lambda c: c[1], lambda c: c[2]]
    observed = [Counter(), Counter(), Counter()]
    for c, n in cells.items():
        for o, k in zip(observed, keys, strict=True):
            o[k(c)] += n
    total = sum(cells.values())
    aims = [tempered({k: v / total for k, v in o.items()}, p) for o, p in zip(observed, margins, strict=True)]
    w = {c: n / total for c, n in cells.items()}
    for _ in range(rounds):
        for k, aim in zip(keys, aims, strict=True):
            held = Counter()
            for c, x in w.items():
                held[k(c)] += x
            w = {c: x * aim[k(c)] / held[k(c)] for c, x in w.items()}
    return w


def test_rake_by_brute_force(spark):
    r = np.random.default_rng(8)
    cells = {(f"s{s}" if s else None, l, t): int(r.integers(1, 900)) for s in range(6) for l in range(3) for t in range(TOPICS) if r.random() < 0.8}
    names = [*LANGUAGES, OTHER]
    df = spark.createDataFrame([(s, l, t, n) for (s, l, t), n in cells.items()], "source string, language int, topic int, tokens long")
    raked = rake(df, names, Margins(0.5, 0.3, 0.0))
    factor = {row["source"]: row["factor"] for row in raked.sources.collect()}
    got = {c: n * factor[c[0]] * raked.languages[c[1]] * raked.topics[c[2]] for c, n in cells.items()}
    assert got == pytest.approx(brute(cells, (0.5, 0.3, 0.0)), abs=1e-6)
    assert raked.residual < 1e-8
    assert raked.largest == pytest.approx(max(got[c] / n for c, n in cells.items()))


def capped_brute(cells, aims, budget, rounds=4000):
    """Raking of min(1, product of factors), cell by cell, to tokens per margin value."""
    factors = [dict.fromkeys(a, budget) for a in aims]
    p = {}
    for _ in range(rounds):
        for k, aim in enumerate(aims):
            p = {c: min(1.0, factors[0][c[0]] * factors[1][c[1]] * factors[2][c[2]]) for c in cells}
            held = Counter()
            for c, n in cells.items():
                held[c[k]] += n * p[c]
            for v in aim:
                factors[k][v] *= aim[v] / held[v] if held[v] else 1.0
    return {c: min(1.0, factors[0][c[0]] * factors[1][c[1]] * factors[2][c[2]]) for c in cells}


def test_capped_probabilities_by_brute_force(spark):
    r = np.random.default_rng(5)
    cells = {(f"s{s}", l, t): int(r.integers(500, 900) * (8 if s == 0 else 1)) for s in range(5) for l in range(3) for t in range(TOPICS)}
    cells["rare", 1, 2] = 6
    names = [*LANGUAGES, OTHER]
    df = spark.createDataFrame([(s, l, t, n) for (s, l, t), n in cells.items()], "source string, language int, topic int, tokens long")
    margins, total = Margins(0.3, 0.6, 0.6), sum(cells.values())
    raked = rake(df, names, margins)
    sampled = cap(df, names, raked, 0.5)
    factor = {row["source"]: row["factor"] for row in sampled.sources.collect()}
    got = {c: min(1.0, factor[c[0]] * sampled.languages[c[1]] * sampled.topics[c[2]]) for c in cells}
    plain = brute(cells, (0.3, 0.6, 0.6))
    aims = []
    for k in range(3):
        values = sorted({c[k] for c in cells})
        share = np.array([sum(w for c, w in plain.items() if c[k] == v) for v in values])
        supply = np.array([sum(n for c, n in cells.items() if c[k] == v) for v in values], dtype=float)
        aims.append(dict(zip(values, within_supply(share / share.sum(), supply, 0.5 * total))))
    want = capped_brute(cells, aims, 0.5)
    assert sum(n * got[c] for c, n in cells.items()) == pytest.approx(0.5 * total, rel=1e-3)
    for k in range(3):
        held = Counter()
        for c, n in cells.items():
            held[c[k]] += n * got[c]
        assert held == pytest.approx(aims[k], rel=5e-3, abs=0.02)
    assert max(abs(got[c] - want[c]) for c in cells) < 0.02 and got["rare", 1, 2] == pytest.approx(1.0, abs=1e-3)


def test_many_sources_are_calibrated_as_few_are(spark):
    """3,400 copies of each of six sources get what the six get alone."""
    r = np.random.default_rng(3)
    shape, names = (6, 3, TOPICS), [*LANGUAGES, OTHER]
    numbers = np.where(r.random(shape) < 0.4, r.integers(1, 900, shape), 0)
    cells = [(f"s{s}", int(l), int(t), int(numbers[s, l, t])) for s, l, t in zip(*numbers.nonzero(), strict=True)]
    few = spark.createDataFrame(cells, "source string, language int, topic int, tokens long")
    factors = spark.createDataFrame([(f"s{s}", s + 1.0) for s in range(6)], "source string, factor double")
    found = []
    for copies in (1, 3_400):
        copied = lambda df, k=copies: df.crossJoin(spark.range(k)).withColumn("source", F.concat_ws("-", "source", "id")).drop("id")
        sampled = cap(copied(few), names, Raked(copied(factors), np.array([1.0, 2, 4, 1, 1]), np.array([1.0, 1, 2, 2, 3, 3, 1, 1]), 1.0, 0.0), 0.5)
        assert sampled.residual < 1e-4
        factor = {row["source"]: row["factor"] for row in sampled.sources.collect()}
        assert len(factor) == 6 * copies
        found.append({(s, l, t): [min(1.0, factor[f"{s}-{k}"] * sampled.languages[l] * sampled.topics[t]) for k in range(copies)] for s, l, t, _ in cells})
    alone, among_many = found
    for cell, (p,) in alone.items():
        assert min(among_many[cell]) == pytest.approx(p, abs=1e-9) and max(among_many[cell]) == pytest.approx(p, abs=1e-9)


def test_source_factors_by_bisection():
    r = np.random.default_rng(4)
    n = np.where(r.random((300, 12)) < 0.6, r.integers(0, 50, (300, 12)), 0).astype(float)
    weights = np.array([0.0, 3, 3, 0.2, 1e-9, 7, 1, 0.5, 0.5, 2, 40, 1e-3])
    can = n[:, 1:].sum(axis=1)
    wanted = can * r.choice([0.0, 0.01, 0.3, 0.9, 1.0, 1.2], 300)
    low, high = np.zeros(300), np.full(300, 1e10)
    for _ in range(200):
        middle = (low + high) / 2
        short = (n * np.minimum(1.0, middle[:, None] * weights)).sum(axis=1) < np.minimum(wanted, can)
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    got = source_factors(n, wanted, weights)
    plain, mine = (np.minimum(1.0, f[:, None] * weights) * (n > 0) for f in (high, got))
    assert np.abs(plain - mine).max() < 1e-6 and not got[can == 0].any()
    assert source_factors(np.zeros((2, 3)), np.zeros(2), np.ones(3)).tolist() == source_factors(np.ones((2, 3)), np.ones(2), np.zeros(3)).tolist() == [0.0, 0.0]


def test_short_values_are_taken_whole():
    out = within_supply(np.array([0.5, 0.3, 0.2]), np.array([10.0, 100.0, 100.0]), 100.0)
    assert out.tolist() == pytest.approx([10.0, 54.0, 36.0])
    assert within_supply(np.array([1.0, 0.0]), np.array([10.0, 10.0]), 20.0).tolist() == pytest.approx([10.0, 10.0])
    assert within_supply(np.zeros(2), np.zeros(2), 0.0).tolist() == [0.0, 0.0]


def test_a_rare_cell_does_not_empty_the_sample(table, make_docs):
    for budget in (0.3, 0.9):
        rows = mix(table("documents"), budget=budget).collect()
        total = sum(r["n_tokens"] for r in rows)
        assert sum(r["probability"] * r["n_tokens"] for r in rows) == pytest.approx(budget * total, rel=0.01)
        assert all(0 < r["probability"] <= 1 for r in rows)
    assert all(r["probability"] == pytest.approx(1.0, abs=1e-3) for r in mix(table("documents"), budget=1.0).collect())
    assert mix(make_docs([]), budget=0.5).collect() == []


def test_sampling_depends_on_the_document_only(make_docs):
    rows = [(i, f"some words of text number {i}", "en", f"s{i % 3}") for i in range(200)]
    first = {r["doc_id"]: r["kept"] for r in mix(make_docs(rows), seed=1).collect()}
    again = {r["doc_id"]: r["kept"] for r in mix(make_docs(rows[::-1]).repartition(7), seed=1).collect()}
    other = {r["doc_id"]: r["kept"] for r in mix(make_docs(rows), margins=Margins(1.0, 1.0, 0.3), seed=2).collect()}
    assert first == again and first != other


def test_odd_documents_and_clashing_names(odd_docs, make_docs):
    out = mix(odd_docs.withColumnRenamed("n_chars", "WEIGHT"))
    rows = out.collect()
    assert len(rows) == 15 and "WEIGHT" not in out.columns
    assert all(0 < r["probability"] <= 1 + 1e-9 and r["n_tokens"] >= 1 and 0 <= r["topic"] < TOPICS for r in rows)
    assert mix(make_docs([])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abÉZ \t\n\x0b\x0c\r\x1c\xa0é"), max_size=80), st.integers(1, 40))
def test_bins_of_a_text_are_those_of_its_words(text, piece):
    words = text.encode().lower().split()
    want = sum((count_words(w.decode()) for w in words), np.zeros(TOPICS, dtype=np.int64))
    before, mixing.PIECE = mixing.PIECE, piece
    try:
        assert count_words(text).tolist() == want.tolist()
    finally:
        mixing.PIECE = before
    assert want.sum() == len(words)
