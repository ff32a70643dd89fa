import random
import re
from itertools import permutations

import numpy as np
from gaugeloft.llm import filter_audit
from gaugeloft.llm.filter_audit import audit, gallop, posting_lists, traits, union, union_sizes
from gaugeloft.llm.queries import op11_filter_audit
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests_support import against_sql

sorted_lists = st.lists(st.integers(0, 60), unique=True).map(lambda x: np.array(sorted(x), dtype=np.int64))


def fails(rows):
    out = []
    for doc, text, part in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        again = doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in rows)
        out.append((
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)), again,
        ))
    return out


def brute(rows, labels):
    """Every order applied filter by filter, document by document."""
    failed = fails(rows)
    marks = [{d for d, *x in labels if x[i] == 1 and d is not None} for i in range(2)]
    out = {}
    for part in {p or "" for *_, p in rows}:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, name in enumerate(order, 1):
                f = "ABCDE".index(name)
                gone = [i for i in left if failed[i][f]]
                redundant = sum(failed[i][f] for i in mine) - len(gone)
                left = [i for i in left if not failed[i][f]]
                unique = sum(failed[i][f] and sum(failed[i]) == 1 for i in mine)
                lost = [sum(rows[i][0] in m for i in gone) for m in marks]
                out[part, order, step] = [name, len(left), len(gone), redundant, unique, *lost]
    total = {}
    for (part, _, _), (name, _, removed, *_) in out.items():
        total[part, name] = total.get((part, name), 0) + removed
    return sorted((*k, *v, total[k[0], v[0]]) for k, v in out.items())


def run(spark, make_docs, rows, labels):
    docs = make_docs([(d, t, p) for d, t, p in rows])
    return sorted(map(tuple, audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()))


def texts(rng):
    words = [f"w{i}" for i in range(300)]
    made = []
    for _ in range(60):
        text = " ".join(rng.choices(words[: rng.choice([40, 300])], k=rng.choice([3, 199, 200, 400])))
        made.append(text.upper() if rng.random() < 0.2 else text + rng.choice(["", "", " #", "\t*"]))
    return made + ["", None, "", " \n", "É" * 50 + "A", "é " * 250]


def test_all_orders_against_documents_one_by_one(spark, make_docs):
    rng = random.Random(1)
    made = texts(rng)
    rows = [(i if i % 17 else None, rng.choice(made), rng.choice(["en", "de", None, ""])) for i in range(200)]
    rows += rows[:5]
    labels = [(rng.randrange(220), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(90)] + [(None, 1, 1)]
    assert run(spark, make_docs, rows, labels) == brute(rows, labels)


def test_ranges_cut_the_lists(spark, make_docs, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE", 16)
    rng = random.Random(2)
    rows = [(i, "same" if i % 3 else rng.choice(["short", "B #"]), "en") for i in range(150)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(150)]
    labels = [(d, q, int(t)) for d, q, t in labels]
    assert run(spark, make_docs, rows, labels) == brute(rows, labels)
    cells = posting_lists(filter_audit.failing(make_docs(rows)).withColumns({"good": F.lit(True), "toxic": F.lit(False)})).collect()
    assert len(cells) >= 10 and max(r["n"] for r in cells) <= 16
    assert all(r["E"] == sorted(r["E"]) and r["toxic"] == [] and len(r["good"]) == r["n"] for r in cells)


def test_empty_tables_and_clashing_columns(spark, make_docs):
    assert run(spark, make_docs, [], [(1, 1, 1)]) == []
    rows = [(1, "a b", "en"), (2, "a b", "en")]
    assert run(spark, make_docs, rows, []) == brute(rows, [])
    docs = make_docs([(d, t, p) for d, t, p in rows]).withColumns({c: F.lit(7) for c in ("row", "part", "A", "least", "good", "n")})
    labels = spark.createDataFrame([(1, 1, 0, 3)], "doc_id long, quality int, toxic int, part int")
    assert sorted(map(tuple, audit(docs, labels).collect())) == brute(rows, [(1, 1, 0)])


@given(sorted_lists, sorted_lists)
def test_galloping(a, b):
    assert gallop(a, b).tolist() == [x in b for x in a]
    assert union(a, b).tolist() == sorted({*a.tolist(), *b.tolist()})


@given(st.lists(sorted_lists, min_size=3, max_size=3), sorted_lists)
def test_sizes_of_unions(lists, label):
    sizes = union_sizes(lists, [label])
    for subset in range(8):
        joined = set().union(*(set(x.tolist()) for i, x in enumerate(lists) if subset >> i & 1))
        assert sizes[subset].tolist() == [len(joined), len(joined & set(label.tolist()))]


def test_limits():
    assert traits("a " * 199)[0] and not traits("a " * 200)[0]
    assert traits("a b b")[1] is False and traits("a a b b b")[1] is True
    assert traits("A" * 3 + "x" * 97)[2] is False and traits("A" * 4 + "é" * 96)[2] is True
    assert traits(None) == (True, False, False, False)


def test_query_equals_sql(spark):
    against_sql(spark, op11_filter_audit, "op11_filter_audit")
