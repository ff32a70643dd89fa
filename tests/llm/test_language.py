import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from gaugeloft.llm.language import BUCKETS, LANGUAGES, STRENGTH, Evidence, domain_of, host_of, identify, suffix_of, trigram_buckets
from gaugeloft.llm.common import text_of
from pyspark.sql import functions as F

PROSE = {"en": "the quick brown fox jumps over the lazy dog and then it rests with the others", "fr": "le renard brun saute par dessus le chien qui dort près de la maison où il vit",
         "de": "der schnelle braune fuchs springt über den faulen hund und dann ruht er sich aus", "es": "el zorro marrón salta sobre el perro que duerme cerca de la casa donde vive"}


def rows_of(n=12):
    return [(10 * k + i, f"{PROSE[lang]} {i}", lang, f"www.{lang}{i % 3}.example.{lang}") for k, lang in enumerate(PROSE) for i in range(n)]


def test_documents_keep_their_language(table):
    docs = table("documents")
    rows = identify(docs).collect()
    assert len(rows) == docs.count()
    assert sum(r["language"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert all(r["accepted"] for r in rows if r["n_chars"] > 50)


def test_held_out_accuracy(spark, table):
    """The likelihoods of one half judge the other half."""
    docs = table("documents")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    evidence = Evidence(docs.filter(half), text_of("text"), F.col("lang"), F.col("source"), LANGUAGES)
    right = []
    for r in docs.filter(~half).collect():
        buckets = [b for b in trigram_buckets(r["text"])]
        best = int(np.sum([evidence.table[:, b].sum(axis=1, dtype=float) for b in buckets], axis=0).argmax())
        right.append(evidence.names[best] == r["lang"])
    assert np.mean(right) > 0.97


def test_priors_by_brute_force(make_docs):
    docs = make_docs(rows_of())
    evidence = Evidence(docs, text_of("text"), F.col("lang"), F.col("source"), LANGUAGES)
    counts = [(r["host"], r["best"], r["n"]) for r in evidence.counts.collect()]
    levels = [lambda h: "", lambda h: h.rsplit(".", 1)[-1], lambda h: ".".join(h.split(".")[-2:]), lambda h: h]
    held = [defaultdict(Counter) for _ in levels]
    for host, best, n in counts:
        for level, name in enumerate(levels):
            held[level][name(host)][best] += n
    names = len(LANGUAGES) + 1
    total = sum(held[0][""].values())
    for row in evidence.priors().collect():
        prior = [(held[0][""][i] + 1) / (total + names) for i in range(names)]
        prior[-1] = min(prior[-1], 1e-3)
        for level in (1, 2, 3):
            c = held[level][levels[level](row["host"])]
            prior = [(c[i] + STRENGTH * p) / (sum(c.values()) + STRENGTH) for i, p in enumerate(prior)]
        assert row["prior"] == pytest.approx(prior)


def test_host_and_declaration_decide_where_text_does_not(make_docs):
    rows = rows_of() + [(900, "zz", None, "www.fr1.example.fr"), (901, "zz", "de-AT", None), (902, "zz", None, None), (903, "zz", "xx", "www.es0.example.es")]
    seen = {r["doc_id"]: r for r in identify(make_docs(rows)).collect()}
    assert (seen[900]["language"], seen[901]["language"], seen[903]["language"]) == ("fr", "de", "es")
    assert 0 < seen[902]["confidence"] < 1


def test_odd_documents_and_clashing_names(odd_docs, make_docs):
    out = identify(odd_docs.withColumnRenamed("n_chars", "Language"))
    rows = out.collect()
    assert len(rows) == 15 and "Language" not in out.columns
    for r in rows:
        assert 0 <= r["confidence"] <= 1 + 1e-9 and not math.isnan(r["confidence"])
        if not (r["text"] or "").strip():
            assert (r["language"], r["confidence"], r["accepted"]) == ("und", 0.0, False)
    digits = {r["doc_id"]: r for r in identify(make_docs([*rows_of(), (800, "12 34 $$", "en", "h")])).collect()}
    assert not digits[800]["accepted"]
    assert identify(make_docs([])).collect() == []


def test_addresses(spark):
    urls = ["https://user@WWW.A.example.fr:80/x?y", "src7", None, "", "http://[x", "a.b.c.d"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(host_of(F.col("u")).alias("h")).select("h", domain_of(F.col("h")), suffix_of(F.col("h")))
    assert [tuple(r) for r in df.collect()] == [("www.a.example.fr", "example.fr", "fr"), ("src7", "src7", ""), ("", "", ""), ("", "", ""), ("[x", "[x", ""), ("a.b.c.d", "c.d", "d")]
    assert max(int(b.max()) for b in trigram_buckets("some text")) < BUCKETS
    long = "ab cé " * 700_000
    assert sum(len(b) for b in trigram_buckets(long)) == len(long.encode()) + 2 - 1 - 2
