import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from gaugeloft.llm.elias_fano import EliasFano
from gaugeloft.llm.token_files import TokenFile, WordTokenizer, read_token_files, write_token_files
from gaugeloft.session import fresh_dir
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1 << 50)), st.integers(0, 3))
def test_elias_fano_round_trip(steps, squeeze):
    values = np.cumsum([s >> (16 * squeeze) for s in steps]).astype(np.uint64) if steps else np.zeros(0, np.uint64)
    if len(values) and int(values[-1]) >= 1 << 62:
        values = np.sort(values % np.uint64(1 << 62))
    made, rest = EliasFano.from_bytes(EliasFano.encode(values).to_bytes() + b"after")
    assert rest == b"after"
    assert made.run(0, len(values)).tolist() == values.tolist()
    for i in random.sample(range(len(values)), min(5, len(values))):
        assert made.select(i) == values[i]
        assert made.run(i, 7).tolist() == values[i : i + 7].tolist()


def test_elias_fano_is_small_and_selects_far_in():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000)).astype(np.uint64)
    made = EliasFano.encode(ends)
    assert len(made.to_bytes()) * 8 / len(ends) < 2 + np.log2(1000) + 1.5
    assert [made.select(i) for i in (0, 63, 64, 99_999)] == ends[[0, 63, 64, 99_999]].tolist()
    with pytest.raises(ValueError, match="fall"):
        EliasFano.encode(np.array([2, 1], dtype=np.uint64))
    with pytest.raises(IndexError):
        made.select(100_000)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.characters(blacklist_categories=("Cs",)), st.sampled_from([*" \n\t'sAé\u0301ẞİ\x85\xa0ſ\x1c", "<|endoftext|>", " don't ", "I'LL", "ÀÉÿŒßŁž", "''s", "x're9", "<|startoftext|>"])), max_size=60).map("".join))
def test_words_in_a_row_are_the_text(text):
    whole = _whole().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(_words().text(text), "<u2").tolist() == whole


_made = {}


def _whole():
    return _made.setdefault("whole", Tokenizer.from_file(PATH))


def _words():
    return _made.setdefault("words", WordTokenizer(PATH))


def expected(rows):
    start, out = 0, []
    for doc, text in rows:
        ids = _whole().encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def run(spark, df):
    path = fresh_dir(spark, "tokens-test")
    manifest = write_token_files(df, path, PATH, 1)
    return path, manifest, sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1])


def test_documents_as_the_library_encodes_them(spark, table):
    docs = table("documents")
    path, manifest, rows = run(spark, docs)
    assert rows == expected(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    part = TokenFile(f"{path}/data", manifest.orderBy("part").first()["name"])
    first = docs.orderBy("doc_id").first()["text"]
    assert part.document(0).tolist() == _whole().encode(first, add_special_tokens=False).ids + [1]
    assert len(part.document(len(part) - 1)) == part.bounds(len(part) - 1, 1)[1] - part.bounds(len(part) - 1, 1)[0]


def test_odd_documents(spark, odd_docs):
    _, _, rows = run(spark, odd_docs)
    want = expected([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in rows) == sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in want)
    assert [r[1] for r in rows] == [0, *np.cumsum([r[2] for r in rows])[:-1].tolist()]
    assert [r[0] for r in rows][:2] == [None, None]


def test_negative_ids_and_empty_table(spark, make_docs):
    _, _, rows = run(spark, make_docs([(-5, "a"), (1 << 62, "b"), (-(1 << 62), "c")]))
    assert [r[0] for r in rows] == [-(1 << 62), -5, 1 << 62]
    assert run(spark, make_docs([]))[2] == []
