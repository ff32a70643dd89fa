"""Licence notices in texts, found through a positional index of rare licence words.

The index holds, for every word of the templates, where it stands in them. A file's licence words are
looked up from the rarest on (by how many documents of the corpus hold them); each occurrence and
each posting together name the place where the template would begin, and places with several votes
are compared word by word. A label needs a sufficient share of the template, weighted by rarity,
and its mandatory phrase standing there in full, with no negation before it.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.llm.common import fresh, put, text_of, workers

#: Phrases that are labels by themselves.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, mandatory phrase, template. The usual wording of notices; words only, as ``words_of`` gives them.
TEMPLATES = [
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "this project is licensed under the terms of the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license version 3"),
    ("agpl", "affero general public license", "licensed under the gnu affero general public license version 3"),
    ("mpl-2.0", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc0", "waived all copyright", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("mit", "mit license", "the mit license mit"),
    ("mit", "without warranty of any kind", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache-2.0", "apache license 2 0", "apache license 2 0"),
    ("apache-2.0", "apache 2 0", "apache 2 0"),
    ("apache-2.0", "apache license", "apache license version 2 0 january 2004 http www apache org licenses"),
    ("apache-2.0", "compliance with the license", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "gnu gpl", "gnu gpl"),
    ("lgpl", "gnu lgpl", "gnu lgpl"),
    ("lgpl", "lesser general public license", "gnu lesser general public license"),
    ("lgpl", "library general public license", "gnu library general public license"),
    ("agpl", "affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license version 2 0"),
    ("mpl-2.0", "mpl 2 0", "mpl 2 0"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms"),
    ("bsd", "clause bsd license", "3 clause bsd license"),
    ("bsd", "bsd 3 clause", "bsd 3 clause license"),
    ("bsd", "bsd 2 clause", "bsd 2 clause license"),
    ("bsd", "bsd license", "bsd style license bsd license"),
    ("bsd", "endorse or promote products", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "isc license", "isc license"),
    ("bsl-1.0", "boost software license", "boost software license version 1 0"),
    ("bsl-1.0", "software license", "distributed under the boost software license version 1 0 see accompanying file license 1 0 txt or copy at"),
    ("epl", "eclipse public license", "eclipse public license v 2 0"),
    ("epl", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license which accompanies this distribution"),
    ("cc0", "cc0 1 0", "cc0 1 0 universal"),
    ("cc0", "dedicated the work to the public domain", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by-sa", "attribution sharealike", "creative commons attribution sharealike 4 0 international"),
    ("cc-by-sa", "attribution share alike", "creative commons attribution share alike license"),
    ("cc-by-nc", "attribution noncommercial", "creative commons attribution noncommercial 4 0 international"),
    ("cc-by-nc", "attribution non commercial", "creative commons attribution non commercial license"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    ("artistic-2.0", "artistic license", "the artistic license 2 0"),
]
#: Label, identifiers of licences as files name them after the words "SPDX-License-Identifier".
IDENTIFIERS = [
    ("mit", "MIT"), ("apache-2.0", "Apache-2.0"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"), ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"), ("agpl", "AGPL-3.0"),
    ("mpl-2.0", "MPL-2.0"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("isc", "ISC"), ("cc0", "CC0-1.0"), ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"),
    ("cc-by-nc", "CC-BY-NC-4.0"), ("unlicense", "Unlicense"), ("bsl-1.0", "BSL-1.0"), ("epl", "EPL-1.0"), ("epl", "EPL-2.0"), ("zlib", "Zlib"), ("artistic-2.0", "Artistic-2.0"),
]
#: Before a notice, or within it, they turn it into its contrary.
NEGATIONS = frozenset(b"not no never neither nor isn aren wasn cannot".split())
REACH = 3
RAREST = 6
VOTES = 2
TOLERANCE = 2
LEAST = 0.6

_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
RESULT = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def words_of(text: str | None) -> list[bytes]:
    """Words of ASCII digits and letters (lower case) and of everything outside ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPACED).split()


def phrase_places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which a phrase starts in words that are joined and framed by single spaces."""
    wanted, at, counted, word = b" " + phrase + b" ", -1, 0, 0
    while (at := joined.find(wanted, at + 1)) >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        yield word


def templates() -> list[tuple[str, list[bytes], list[bytes]]]:
    """Label, mandatory phrase and words of every template; an identifier is its own mandatory phrase."""
    plain = [(label, must.encode().split(), text.encode().split()) for label, must, text in TEMPLATES]
    named = [(label, words_of(f"spdx license identifier {name}")) for label, name in IDENTIFIERS]
    return plain + [(label, words, words) for label, words in named]


def negated(words: list[bytes], must: list[bytes], template: list[bytes], at: int) -> bool:
    """Whether a negation stands among the words of a notice before its mandatory phrase ``at``, or shortly before the notice."""
    lead = next((i for i in range(len(template) - len(must) + 1) if template[i : i + len(must)] == must), 0)
    return bool(NEGATIONS.intersection(words[max(0, at - lead - REACH) : at]) - set(template))


class Index:
    """The templates with their postings; ``idf`` weighs their words."""

    def __init__(self, idf: dict[bytes, float]):
        self.idf = idf
        self.templates = templates()
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (_, _, words) in enumerate(self.templates):
            for place, word in enumerate(words):
                self.postings[word].append((t, place))

    def labels(self, words: list[bytes]) -> dict[str, float]:
        """Label to the best share of a template found with its mandatory phrase.

        Templates whose phrase has a word that the file lacks are out before any place is looked up.
        """
        present = self.postings.keys() & set(words)
        able = {t for t, (_, must, _) in enumerate(self.templates) if present.issuperset(must)}
        if not able:
            return {}
        ranked = sorted(present, key=lambda w: (-self.idf.get(w, 0.0), w))
        used: Counter[int] = Counter()
        chosen: dict[bytes, list[tuple[int, int]]] = {}
        for word in ranked:
            mine = [(t, place) for t, place in self.postings[word] if t in able and used[t] < RAREST]
            if mine:
                chosen[word] = mine
                used.update({t for t, _ in mine})
        votes: Counter[tuple[int, int]] = Counter()
        for at, word in enumerate(words):
            if word in chosen:
                votes.update((t, at - place) for t, place in chosen[word])
        found: dict[str, float] = {}
        for t, start in votes:
            label, must, template = self.templates[t]
            near = sum(votes[t, start + d] for d in range(-TOLERANCE, TOLERANCE + 1))
            if near >= min(VOTES, len(template)):
                share = self._share(words, template, start)
                if share > max(LEAST - 1e-9, found.get(label, 0.0)) and self._stands(words, must, template, start):
                    found[label] = share
        return found

    def _share(self, words: list[bytes], template: list[bytes], start: int) -> float:
        total = hit = 0.0
        for place, word in enumerate(template):
            weight = self.idf.get(word, 0.0)
            total += weight
            at = start + place
            if word in words[max(0, at - TOLERANCE) : max(0, at + TOLERANCE + 1)]:
                hit += weight
        return hit / total if total else 0.0

    @staticmethod
    def _stands(words: list[bytes], must: list[bytes], template: list[bytes], start: int) -> bool:
        """Whether the mandatory phrase is there, with no negation that the template lacks before it."""
        low, high = max(0, start - TOLERANCE), start + len(template) + TOLERANCE
        places = (at for at in range(low, high - len(must) + 1) if words[at : at + len(must)] == must)
        return any(not negated(words, must, template, at) for at in places)


def vocabulary() -> set[bytes]:
    return {word for _, _, words in templates() for word in words}


def licence_idf(df: DataFrame, text_column: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of the templates' words over all rows.

    Each task sends one row per template word, so what reaches the driver has the size of the templates.
    """
    wanted = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seen = 0, Counter()
        for batch in batches:
            for text in batch.column(0):
                rows += 1
                seen.update(wanted & set(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(["", *(w.decode() for w in seen)]), pa.array([rows, *seen.values()], pa.int64())], ["word", "n"])

    counts = workers(df).select(text_of(text_column).alias("text")).mapInArrow(count, "word string, n bigint")
    totals = {word: n for word, n in counts.groupBy("word").agg(F.sum("n")).collect()}
    rows = totals.pop("", 0)
    return {w: math.log((rows + 1) / (totals.get(w.decode(), 0) + 1)) + 1 for w in wanted}


def scan_licences(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds ``n_words, n_base, first_word, last_word, base_labels, labels, score``; input columns of these names are replaced.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the smallest and
    largest word number where one starts, else null. Labels are distinct, sorted and comma-joined, and
    ``labels`` holds the base ones too. ``score`` is 1 with a base phrase, else the best template share of
    a label, else 0. A null or empty text has no words. Texts are scanned whole. Repeated rows give
    repeated results, an empty table an empty one.
    """
    index = Index(licence_idf(df, text_column))
    bases = {phrase.encode(): label for phrase, label in BASE_PHRASES.items()}

    def judge(text: str | None) -> tuple:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, label in bases.items():
            if found := list(phrase_places(joined, phrase)):
                places += found
                labels.add(label)
        more = index.labels(words)
        score = 1.0 if labels else max(more.values(), default=0.0)
        first, last = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | more.keys())), score

    names = [f.split()[0] for f in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([judge(t) for t in texts], columns=names)
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    found = fresh("found")
    marked = df.withColumn(found, scan(text_of(text_column)))
    return put(marked, {name: F.col(found)[name] for name in names}).drop(found)
