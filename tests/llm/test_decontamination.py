import random

import numpy as np
import pytest
from gaugeloft.llm import decontamination
from gaugeloft.llm.decontamination import GAP, MATCH, MISMATCH, Block, align, decontaminate, find_leaks, needed_words, segments

ITEMS = "item_id long, text string"


def plain_align(item, passage):
    """Smith-Waterman cell by cell."""
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (MATCH if a == b else MISMATCH), rows[i - 1][j] + GAP, rows[i][j - 1] + GAP)
            best = max(best, rows[i][j])
    return best


def test_alignment_by_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        item, passage = ([rng.randrange(6) for _ in range(rng.randrange(1, 25))] for _ in "ab")
        assert align(np.array(item), np.array(passage))[0] == plain_align(item, passage)


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def leaks(spark, docs, items):
    return sorted((r["doc_id"], r["item_id"], round(r["score"], 3), r["first_word"], r["last_word"]) for r in find_leaks(docs, spark.createDataFrame(items, ITEMS)).collect())


def test_copies_edits_and_clean_documents(spark, make_docs):
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, rng.randrange(12, 60)))) for i in range(25)]
    docs, want = [], set()
    for i in range(120):
        body = words(rng, 300)
        if i % 3 == 0:
            item = rng.randrange(25)
            copy = items[item][1].split()
            if i % 2:
                copy = [rng.choice(["x", "y", "z"]) if k % 8 == 5 else w for k, w in enumerate(copy) if k % 19 != 11]
            body[100:100] = copy
            want.add((i, item))
        docs.append((i, " ".join(body)))
    found = leaks(spark, make_docs(docs), items)
    assert {(d, item) for d, item, *_ in found} == want
    exact = {(d, item): rest for d, item, *rest in found}
    for d, item in want:
        score, first, last = exact[d, item]
        if d % 2 == 0:
            assert (score, first, last) == (1.0, 100, 100 + len(items[item][1].split()) - 1)
        assert score > 0.6
    kept = decontaminate(make_docs(docs), spark.createDataFrame(items, ITEMS))
    assert {r["doc_id"] for r in kept.collect()} == set(range(120)) - {d for d, _ in want}


def test_by_brute_force_on_all_documents(spark, table):
    docs, items = table("documents"), table("benchmark")
    from gaugeloft.llm.licenses import words_of

    found = {(r["doc_id"], r["item_id"]): r["score"] for r in find_leaks(docs, items).collect()}
    benchmark = {r["item_id"]: words_of(r["text"]) for r in items.collect()}
    for doc in docs.collect():
        held = words_of(doc["text"])
        joined = b" " + b" ".join(held) + b" "
        for item, text in benchmark.items():
            if b" " + b" ".join(text) + b" " in joined:
                assert found[doc["doc_id"], item] == 1.0
    for (d, item), score in found.items():
        held = {r["doc_id"]: r for r in docs.filter(f"doc_id = {d}").collect()}[d]
        numbers = {w: n for n, w in enumerate({*words_of(held["text"]), *benchmark[item]})}
        a, b = (np.array([numbers[w] for w in x]) for x in (benchmark[item], words_of(held["text"])))
        assert score == pytest.approx(align(a, b)[0] / (MATCH * len(a)))


def test_a_passage_leaked_everywhere_and_blocks(spark, make_docs, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, 30))) for i in range(6)] + [(9, None), (10, ""), (11, "two words"), (12, "three short words"), (0, None)]
    docs = make_docs([(i, f"before it {items[0][1]} after") for i in range(50)] + [(60, "three short words"), (61, None), (None, items[1][1]), (62, "")])
    want = sorted([(i, 0, 1.0, 2, 31) for i in range(50)] + [(60, 12, 1.0, 0, 2), (None, 1, 1.0, 0, 29)], key=str)
    assert sorted(leaks_any(spark, docs, items), key=str) == want
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 20)
    assert sorted(leaks_any(spark, docs, items), key=str) == want
    kept = decontaminate(docs, spark.createDataFrame(items, ITEMS))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == [(61, None), (62, "")]
    assert kept.columns == docs.columns


def leaks_any(spark, docs, items):
    return [(r["doc_id"], r["item_id"], round(r["score"], 3), r["first_word"], r["last_word"]) for r in find_leaks(docs, spark.createDataFrame(items, ITEMS)).collect()]


def test_long_items_and_empty_tables(spark, make_docs, odd_docs):
    rng = random.Random(3)
    long = words(rng, 1000)
    assert [len(s) for s in segments([b"w"] * 1000)] == [256, 256, 256, 256, 232]
    docs = make_docs([(1, " ".join(long[300:600])), (2, " ".join(words(rng, 400)))])
    assert [(d, i) for d, i, *_ in leaks(spark, docs, [(5, " ".join(long))])] == [(1, 5)]
    assert leaks(spark, make_docs([]), [(5, " ".join(long))]) == []
    assert leaks_any(spark, odd_docs, []) == []


def edited(rng, passage, share):
    """Words replaced, left out or doubled, in equal parts."""
    out = []
    for w in passage:
        if rng.random() >= share:
            out.append(w)
        elif (kind := rng.randrange(3)) != 0:
            out += [f"x{rng.randrange(999)}"] if kind == 1 else [w, f"y{rng.randrange(999)}"]
    return out


def recall(length, share, item_words=600, tries=60):
    rng = random.Random(length * 100 + int(share * 100))
    item = words(rng, item_words)
    block = Block([(1, " ".join(item))])
    block.choose_seeds(np.zeros(len(block.known), dtype=np.int64))
    found = 0
    for _ in range(tries):
        at = rng.randrange(item_words - length + 1)
        doc = words(rng, 80) + edited(rng, item[at : at + length], share) + words(rng, 80)
        found += bool(block.leaks(" ".join(doc)))
    return found / tries


def test_recall_of_passages_of_a_long_item():
    table = {(n, s): recall(n, s) for n in (50, 100, 200) for s in (0.0, 0.1, 0.2)}
    print(table, recall(20, 0.0))
    assert all(r == 1.0 for (n, s), r in table.items() if s == 0.0)
    assert all(r >= 0.9 for (n, s), r in table.items() if s <= 0.1 or n > 50)


def test_an_edit_in_a_short_item(spark, make_docs):
    text = "alpha beta gamma delta epsilon zeta eta theta iota"
    for n in (6, 7, 8, 9):
        item = text.split()[:n]
        one_edit = [w if i != n // 2 else "other" for i, w in enumerate(item)]
        assert [d for d, *_ in leaks(spark, make_docs([(1, "so " + " ".join(one_edit) + " end"), (2, " ".join(item[:3]) + " and nothing else")]), [(1, " ".join(item))])] == [1]
    assert [needed_words(n) for n in (3, 5, 6, 8, 9, 12, 40, 59, 61, 256)] == [3, 5, 4.5, 6, 6, 6, 20, 29.5, 30, 30]


def test_repeated_items_and_other_names(spark, make_docs):
    docs = make_docs([(1, "one two three four five six seven eight nine"), (2, "nothing of it")]).withColumnRenamed("text", "Text")
    items = [(i, "one two three four five six seven eight nine") for i in (3, 4, 4, None)]
    assert sorted(leaks_any(spark, docs, items), key=str) == sorted([(1, i, 1.0, 0, 8) for i in (3, 4, None)], key=str)
    assert [r["doc_id"] for r in decontaminate(docs, spark.createDataFrame(items, ITEMS)).collect()] == [2]
