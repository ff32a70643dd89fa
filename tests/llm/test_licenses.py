import random
import re

import pytest
from gaugeloft.llm.licenses import BASE_PHRASES, LEAST, TOLERANCE, Index, licence_idf, negated, scan_licences, templates, vocabulary, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    """The base part, straight from its definition."""
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        wanted = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def base_of(row):
    return row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]


def test_base_of_all_documents(table):
    docs = table("documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = scan_licences(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert base_of(row) == plain(texts[row["doc_id"]])
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}
        assert 0 <= row["score"] <= 1
    notices = {"Released under the MIT License.": "mit", "Apache License, Version 2.0": "apache-2.0", "CC BY-NC": "cc-by-nc", "GNU General Public License": "gpl"}
    for row in rows:
        for notice, label in notices.items():
            if notice in texts[row["doc_id"]]:
                assert label in row["labels"].split(",")


@pytest.mark.parametrize(
    "text, labels, n_base",
    [
        ("All rights reserved. CC-BY cc by; the General  Public\nLicense", "cc-by,gpl,reserved", 4),
        ("Released under the MIT License.", "mit", 0),
        ("This project is licensed under the terms of the MIT license, see below", "mit", 0),
        ("the license of mit students under the terms released", "", 0),
        ("Licensed under the Apache License, Version 2.0", "apache-2.0", 0),
        ("This Source Code Form is subject to all terms of the Mozilla Public License v. 2.0", "mpl-2.0", 0),
        ("cc by cc by cc", "cc-by", 2),
        ("// SPDX-License-Identifier: MIT", "mit", 0),
        ("# SPDX-License-Identifier: BSD-3-Clause\nimport os", "bsd", 0),
        ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl", 0),
        ("subject to the Mozilla Public License, version 2.0.", "mpl-2.0", 0),
        ("License: Apache-2.0", "apache-2.0", 0),
        ("GNU LGPL v2.1", "lgpl", 0),
        ("CC0 1.0 Universal", "cc0", 0),
        ("Redistribution and use in source and binary forms, with or without", "bsd", 0),
        ("Boost Software License - Version 1.0 - August 17th, 2003", "bsl-1.0", 0),
        ("made available under the terms of the Eclipse Public License 2.0", "epl", 0),
        ("This is not released under the MIT license.", "", 0),
        ("It isn't licensed under the Apache License, Version 2.0", "", 0),
        ("You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0", 0),
        ("MIT students met Apache pilots in the Mozilla office; no license", "", 0),
        ("", "", 0),
        (None, "", 0),
    ],
)
def test_labels(make_docs, text, labels, n_base):
    row = scan_licences(make_docs([(1, text), (2, "no notice at all")])).filter("doc_id = 1").first()
    assert (row["labels"], row["n_base"]) == (labels, n_base)
    assert base_of(row) == plain(text)


def test_odd_documents_and_clashing_names(make_docs, odd_docs):
    rows = scan_licences(odd_docs.withColumnRenamed("n_chars", "Score")).collect()
    assert len(rows) == 15
    assert all(base_of(r) == plain(r["text"]) and r["score"] == 0 for r in rows)
    assert "Score" not in rows[0].asDict()
    assert scan_licences(make_docs([])).collect() == []


def test_a_word_repeated_very_often():
    words = words_of("license " * 50_000 + "released under the MIT license")
    assert Index(dict.fromkeys(vocabulary(), 1.0)).labels(words) == {"mit": 1.0}


def brute_labels(words, idf):
    """Every template laid on every place."""
    found = {}
    for label, must, template in templates():
        total = sum(idf[w] for w in template)
        for start in range(-len(template), len(words) + 1):
            near = lambda at: words[max(0, at - TOLERANCE) : max(0, at + TOLERANCE + 1)]
            share = sum(idf[w] for i, w in enumerate(template) if w in near(start + i)) / total
            if share < LEAST - 1e-9:
                continue
            places = [i for i in range(max(0, start - TOLERANCE), start + len(template) + TOLERANCE - len(must) + 1) if words[i : i + len(must)] == must]
            if any(not negated(words, must, template, at) for at in places):
                found[label] = max(found.get(label, 0.0), share)
    return found


def test_labels_by_brute_force(table):
    docs = table("documents")
    idf = licence_idf(docs)
    index = Index(idf)
    rng = random.Random(6)
    texts = [words_of(r["text"])[:400] for r in docs.limit(40).collect()]
    for _, must, template in templates() * 2:
        edited = [w for w in template if rng.random() > 0.1] if rng.random() < 0.5 else template
        filler = [rng.choice([b"some", b"word", b"license", b"the", b"of", b"not"]) for _ in range(12)]
        texts.append(filler[:6] + edited + filler[6:])
    for words in texts:
        want, got = brute_labels(words, idf), index.labels(words)
        assert got.keys() == want.keys(), (words, got, want)
        assert all(got[label] <= want[label] + 1e-9 for label in got)
        assert all(got[label] == pytest.approx(want[label], abs=0.25) for label in got)
