import numpy as np
import pytest
from gaugeloft.llm.queries import op1_sharding
from gaugeloft.llm.sharding import Permutation, number_rows, shard_rows
from hypothesis import given
from hypothesis import strategies as st

from tests_support import SF, against_sql


@given(st.integers(1, 3000), st.integers(0, 1 << 40))
def test_permutation_is_one_and_invertible(count, seed):
    permutation = Permutation(count, seed)
    numbers = np.arange(count)
    places = permutation.position(numbers)
    assert sorted(places.tolist()) == numbers.tolist()
    assert (permutation.number(places) == numbers).all()


def test_large_domains_and_seeds():
    p = Permutation((1 << 40) + 7, 3)
    some = np.random.default_rng(0).integers(0, p.count, 10_000)
    assert (p.number(p.position(some)) == some).all() and p.position(some).max() < p.count
    assert (Permutation(1000, 1).position(np.arange(1000)) != Permutation(1000, 2).position(np.arange(1000))).mean() > 0.9


def test_rows_law_whatever_the_partitions(spark, make_docs):
    rows = [(i, f"text {i}") for i in range(1003)]
    first = shard_rows(make_docs(rows), ["doc_id"], 8, 5)
    again = shard_rows(make_docs(rows[::-1]).repartition(13), ["doc_id"], 8, 5)
    seen = {r["doc_id"]: (r["shard"], r["slot"]) for r in first.collect()}
    assert seen == {r["doc_id"]: (r["shard"], r["slot"]) for r in again.collect()}
    by_shard = [sorted(slot for shard, slot in seen.values() if shard == s) for s in range(8)]
    assert all(slots == list(range(len(slots))) for slots in by_shard)
    assert {len(s) for s in by_shard} <= {125, 126}


def test_odd_rows(odd_docs, make_docs):
    out = shard_rows(odd_docs.withColumnRenamed("n_chars", "SHARD"), ["doc_id", "text"], 4)
    rows = out.collect()
    assert len(rows) == 15 and "SHARD" not in out.columns
    assert sorted(r["row_number"] for r in rows) == list(range(15))
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["row_number"])][:2] == [None, None]
    same = shard_rows(make_docs([(1, "x")] * 50), ["doc_id"], 4).collect()
    assert len({(r["shard"], r["slot"]) for r in same}) == 50
    assert shard_rows(make_docs([]), ["doc_id"], 4).collect() == []
    with pytest.raises(ValueError, match="one shard"):
        shard_rows(odd_docs, ["doc_id"], 0)


def test_numbers_follow_the_order(make_docs):
    numbered, count = number_rows(make_docs([(5, "a"), (None, "b"), (2, "c")]), ["doc_id"], "n")
    assert count == 3
    assert [r["text"] for r in numbered.orderBy("n").collect()] == ["b", "c", "a"]


def test_query_equals_sql(spark):
    against_sql(spark, op1_sharding, "op1_sharding", SF)
