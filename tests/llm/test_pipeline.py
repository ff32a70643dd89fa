"""The stages in a row, and the entry with and without this package."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import numpy as np
from gaugeloft.llm import mixing
from gaugeloft.llm.decontamination import MATCH, align, needed_words
from gaugeloft.llm.licenses import words_of
from gaugeloft.llm.mixing import LANGUAGES, TOPICS, Raked, mix
from gaugeloft.llm.shingles import word_hashes
from gaugeloft.operators import joins
from pyspark.sql import functions as F

from test_minhash import brute
from tests_support import SF

ROOT = Path(__file__).resolve().parents[2]


def test_stages(spark, table):
    docs = table("documents")
    columns = docs.columns
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    names = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        names.append(name)
        rows = out.collect()
        now = {r["doc_id"] for r in rows}
        assert now <= kept and len(now) == len(rows)
        assert out.columns[: len(columns)] == columns and (out.columns == columns or name == "sharding")
        assert len(now) > 0.3 * len(kept)
        kept, docs = now, out
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert sorted(r["row_number"] for r in rows) == list(range(len(rows)))


def test_mixing_of_many_sources_is_that_of_few(spark, make_docs, monkeypatch):
    """The stage samples 3,400 copies of six sources with the probabilities that the six get alone."""
    r = np.random.default_rng(3)
    shape = (6, 3, TOPICS)
    numbers = np.where(r.random(shape) < 0.4, r.integers(2, 20, shape), 0)
    words = ["w2", "w1", "w19", "w14", "w0", "w7", "w3", "w4"]  # a word of each topic
    few = make_docs([(i, f"{words[t]} " * int(numbers[s, l, t] - 1), LANGUAGES[l], f"s{s}") for i, (s, l, t) in enumerate(zip(*numbers.nonzero(), strict=True))])

    def given(cells, names, margins):
        factor = F.substring("source", 2, 1).cast("double") + 1
        return Raked(cells.select("source", factor.alias("factor")).distinct(), np.array([1.0, 2, 4, 1, 1]), np.array([1.0, 1, 2, 2, 3, 3, 1, 1]), 1.0, 0.0)

    monkeypatch.setattr(mixing, "rake", given)
    alone = {x["doc_id"]: x["probability"] for x in mix(few, budget=corpus_pipeline.BUDGET).collect()}
    assert 0 < min(alone.values()) < 0.1
    many = few.crossJoin(spark.range(3_400)).withColumns({"source": F.concat_ws("-", "source", "id"), "doc_id": F.col("doc_id") * 3_400 + F.col("id")}).drop("id")
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(corpus_pipeline.SEED), "doc_id", "text"), 11) / float(1 << 53)
    want = {x["doc_id"] for x in many.select("doc_id", uniform.alias("u")).collect() if x["u"] < alone[x["doc_id"] // 3_400]}
    assert {x["doc_id"] for x in corpus_pipeline.mix_sources(spark, many, "").select("doc_id").collect()} == want


def test_mixing_is_the_same_by_either_join(spark, make_docs, monkeypatch):
    """The stage keeps the same documents whether the table of sources is broadcast or, as if it were large, shuffled."""
    docs = make_docs([(i // 2, f"some words of text number {i % 90} " * (1 + i % 5), LANGUAGES[i % 3], f"s{i % 4}" if i % 7 else None) for i in range(400)])
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before, kept = spark.conf.get(threshold), []
    spark.conf.set(threshold, "-1")
    try:
        for rows, join in ((joins.MAX_BROADCAST_ROWS, "BroadcastHashJoin"), (-1, "SortMergeJoin")):
            monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", rows)
            out = corpus_pipeline.mix_sources(spark, docs, "")
            assert join in out._jdf.queryExecution().executedPlan().toString()
            kept.append(sorted(r["doc_id"] for r in out.select("doc_id").collect()))
    finally:
        spark.conf.set(threshold, before)
    assert kept[0] == kept[1] and 0 < len(kept[0]) < docs.count()


def plain_leaks(texts, items):
    """Documents that any item aligns with, cell by cell over the whole text, without seeds."""
    out = set()
    for doc, text in texts.items():
        held = word_hashes(words_of(text))
        for item in items:
            words = word_hashes(words_of(item))
            if 3 <= len(words) and len(held) and np.isin(words, held).sum() >= needed_words(len(words)):
                if align(words, held)[0] >= MATCH * needed_words(len(words)):
                    out.add(doc)
                    break
    return out


def test_stages_by_brute_force(spark, table):
    """Each stage on its own input against a plain version of its rule."""
    stages = dict(corpus_pipeline.STAGES)
    docs = table("documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = {d: len((t or "").encode().lower().split()) + 1 for d, t in texts.items()}
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    groups = brute(list(texts.items()), 5)
    assert ids(stages["near_duplicates"](spark, docs, SF)) == {d for d, n, least, kept in groups if kept}
    items = [r["text"] for r in table("benchmark").collect()]
    assert ids(stages["decontamination"](spark, docs, SF)) == texts.keys() - plain_leaks(texts, items)
    mixed = ids(stages["mixing"](spark, docs, SF))
    kept = {r["doc_id"]: (r["kept"], r["probability"]) for r in mix(docs, seed=corpus_pipeline.SEED, budget=corpus_pipeline.BUDGET).collect()}
    assert mixed == {d for d, (k, _) in kept.items() if k}
    expected = sum(p * sizes[d] for d, (_, p) in kept.items())
    spread = sum(p * (1 - p) * sizes[d] ** 2 for d, (_, p) in kept.items()) ** 0.5
    assert abs(expected - corpus_pipeline.BUDGET * sum(sizes.values())) < 0.02 * expected and abs(sum(sizes[d] for d in mixed) - expected) < 4 * spread
    dealt = stages["sharding"](spark, docs, SF).collect()
    shards = {}
    for r in dealt:
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert {r["doc_id"] for r in dealt} == texts.keys() and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "shard", "slot"} <= set(out.columns) and out.count() > 20


def test_entry_without_this_package(tmp_path):
    for name in ("gaugeloft", "__spark_entry__.py"):
        source = ROOT / name
        copy = shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path)
        assert copy
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') for n in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr


def test_all_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
