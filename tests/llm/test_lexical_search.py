import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from gaugeloft.llm import lexical_search
from gaugeloft.llm.lexical_search import Block, bounds_of, coordinate, search, sketch, terms_of
from gaugeloft.llm.queries import op13_lexical_search
from pyspark.sql import functions as F

from tests_support import against_sql

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    count, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            m = 10 + 90 * c.total() * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=10, **more):
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search(spark.createDataFrame(docs, "doc_id long, text string"), asked, k, **more).collect()), key=str)


def corpus(rng, n):
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(words, weights, k=int(rng.lognormvariate(3.5, 1)) + 1))) for i in range(n)]


def test_random_documents(spark, monkeypatch):
    rng = random.Random(3)
    docs = corpus(rng, 400)
    items = [(i, " ".join(rng.sample(rng.choice(docs)[1].split(), 1) + rng.choices([f"w{j}" for j in range(420)], k=rng.randrange(20)))) for i in range(40)]
    assert run(spark, docs, items) == brute(docs, items, 10)
    monkeypatch.setattr(lexical_search, "COORDINATES", 16)
    monkeypatch.setattr(lexical_search, "CELLS", 100)
    monkeypatch.setattr(lexical_search, "BLOCK_CHARS", 700)
    monkeypatch.setattr(lexical_search, "FLUSH", 50)
    assert run(spark, docs[:150], items, 3) == brute(docs[:150], items, 3)


def test_copies_ties_and_odd_rows(spark):
    docs = [(i, "the same line of words") for i in range(300, 0, -1)] + [(500, None), (501, ""), (502, "?!\x7f"), (None, "the same line of words"), (7, "the same line of words")]
    docs += [(600, "Élan VITAL élan"), (601, "élan vital"), (602, "x" * 200_000), (603, "rare " * 70_000 + "line")]
    items = [(1, "SAME line"), (1, "SAME line"), (2, "Élan"), (3, "élan vital rare"), (4, None), (5, "- -"), (None, "line"), (6, "absent"), (7, "x" * 200_000)]
    assert run(spark, docs, items) == brute(docs, items, 10)
    assert run(spark, [(None, "a b"), (None, "a b"), (3, "a")], [(1, "a b")]) == brute([(None, "a b"), (None, "a b"), (3, "a")], [(1, "a b")], 10)


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("term", "n", "query", "bound", "text_hash")})
    items = spark.createDataFrame([(9, "a c")], "item_id long, text string").withColumn("row", F.lit(1))
    assert sorted(map(tuple, search(docs, items, 10).collect())) == brute([(1, "a b"), (2, "b c")], [(9, "a c")], 10)


def test_terms():
    for text in (None, "", "A-b_c9É x\x1fq", "Straße İ ẞ", "日本 語"):
        assert [t.decode() for t in terms_of(text)] == terms(text)


def test_bounds_are_never_below_the_scores():
    rng = random.Random(5)
    docs = corpus(rng, 60)
    counts = [Counter(terms_of(t)) for _, t in docs]
    weights = [{f"w{rng.randrange(400)}".encode(): rng.randrange(5000) for _ in range(rng.randrange(30))} for _ in range(25)]
    block = Block(weights, len(docs), sum(c.total() for c in counts))
    sketches = [sketch(c, {t: coordinate(t) for t in c}) for c in counts]
    ints = pa.list_(pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array([c.total() for c in counts]), pa.array([s[0] for s in sketches], ints), pa.array([s[1] for s in sketches], ints)], ["n", "coordinates", "counts"])
    (_, bounds), = bounds_of(batch, block, block.postings())
    scores = np.array([[block.score(q, c, c.total()) for q in range(25)] for c in counts])
    assert (bounds >= scores).all() and (bounds == scores).mean() > 0.9


def test_query_equals_sql(spark):
    against_sql(spark, op13_lexical_search, "op13_lexical_search")
