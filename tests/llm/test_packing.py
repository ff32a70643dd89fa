import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from gaugeloft.llm import packing
from gaugeloft.llm.packing import ByteTokenizer, cuts, pack, plan, ranked, sequences
from gaugeloft.llm.queries import op12_packing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests_support import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
WORDS = ByteTokenizer(PATH)
ODD = [*" \n\t'sAé́ẞİ\x85\xa0ſ\x1c0١×", "<|endoftext|>", " don't ", "I'LL", "ÀÉÿŒßŁž", "''s", "x're9", "  ", " \n ", "日本", "　", " ", "😀", "\r\n", "­", "\x7f"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.characters(blacklist_categories=("Cs",)), st.sampled_from(ODD)), max_size=40).map("".join))
def test_words_in_a_row_are_the_text(text):
    assert WORDS.text(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_given_texts(table):
    for row in table("documents").select("text").collect():
        assert WORDS.text(row["text"]).tolist() == WHOLE.encode(row["text"], add_special_tokens=False).ids


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    small = ByteTokenizer(PATH)
    text = "one two, three; four 5th don't one two, " * 3 + "x" * 100
    assert small.by_word and small.text(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@given(st.integers(1, 500), st.integers(1, 40))
def test_only_the_first_piece_is_shorter(total, capacity):
    places = cuts(total, capacity)
    lengths = np.diff(places)
    assert places[0] == 0 and places[-1] == total and 0 < lengths[0] <= capacity and (lengths[1:] == capacity).all()


def filled(runs, capacity):
    """What a plan puts where: offsets and lengths by sequence, checked for gaps."""
    held = {}
    for length, first, count, sequence, offset in runs:
        for i in range(count):
            held.setdefault(sequence + i, []).append((offset, length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return held


def one_by_one(lengths, capacity):
    """Best-fit, longest first, a document at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else capacity) - length)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=200))
def test_plan_is_best_fit(lengths):
    counts = Counter(lengths)
    runs = plan(counts, 30)
    held = filled(runs, 30)
    assert Counter(n for pieces in held.values() for _, n in pieces) == counts
    assert len(held) == one_by_one(lengths, 30) and sorted(held) == list(range(len(held)))
    for length in counts:
        ranks = sorted((f, f + c) for n, f, c, _, _ in runs if n == length)
        assert [a for a, _ in ranks] == [0, *[b for _, b in ranks[:-1]]] and ranks[-1][1] == counts[length]


def test_a_plan_does_not_grow_with_the_documents():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 1000) for n in range(1, 1025)}
    runs = plan(counts), plan({n: c * 1_000_003 for n, c in counts.items()})
    assert max(map(len, runs)) < 4 * 1024
    used = max(r[3] + r[2] for r in runs[1])
    assert used <= 1.01 * sum(n * c for n, c in counts.items()) * 1_000_003 / 1024
    with pytest.raises(ValueError, match="does not fit"):
        plan({1025: 1})


def test_ranks_of_a_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    rows = [(i, 0, 7 if i % 3 else i % 11) for i in range(3000)]
    out = ranked(spark.createDataFrame(rows, "row long, piece int, length long"), 3000).collect()
    for length, n in Counter(r[2] for r in rows).items():
        assert sorted(r["rank"] for r in out if r["length"] == length) == list(range(n))


def check(docs, capacity):
    packed = pack(docs, PATH, 2, capacity).collect()
    given_rows = docs.select("doc_id", "text").collect()
    want = Counter()
    for r in given_rows:
        ids = np.array([*WHOLE.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        places = cuts(len(ids), capacity)
        for piece, (a, b) in enumerate(zip(places, places[1:])):
            want[r["doc_id"], piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    held = {}
    for r in packed:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) == one_by_one([k[3] for k, n in want.items() for _ in range(n)], capacity)


def test_given_documents(table):
    check(table("documents"), 1024)
    assert op12_packing.__name__ and table("documents").count()


def test_odd_documents(odd_docs, make_docs):
    check(odd_docs, 16)
    clash = odd_docs.withColumnsRenamed({"lang": "row", "source": "length"}).withColumn("rank", F.lit(1))
    check(clash, 1024)
    assert pack(make_docs([]), PATH, 2).collect() == []


def test_sequences_hold_the_ids(table):
    packed = pack(table("documents"), PATH, 2)
    whole = {}
    for r in packed.collect():
        whole.setdefault(r["sequence_id"], []).append((r["offset"], bytes(r["ids"]), r["doc_id"]))
    made = sequences(packed).collect()
    for r in made:
        pieces = sorted(whole[r["sequence_id"]])
        assert bytes(r["ids"]) == b"".join(p[1] for p in pieces) and r["doc_ids"] == [p[2] for p in pieces] and r["n_ids"] == sum(r["lengths"]) == len(r["ids"]) // 2
    assert len(made) == len(whole)


def test_query(spark):
    out = op12_packing(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
