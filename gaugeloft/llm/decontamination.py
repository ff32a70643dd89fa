"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Benchmark items are cut into segments. In every window of three consecutive word trigrams of a segment
the one that fewest documents hold is a seed, so that any five words left as they were hold one, and a
passage that leaked into many documents still has its seeds. Where a document holds a seed, the words
around it are aligned with the segment; the score is the best local alignment over a perfect one.

Documents are read in place and never shuffled. The benchmark comes in blocks of bounded size, each of which
is broadcast; a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.llm.common import text_of, workers
from gaugeloft.llm.licenses import words_of
from gaugeloft.llm.shingles import gram_hashes, word_hashes
from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

GRAM = 3
WINDOW = 3
SEGMENT = 256
STEP = 192
BLOCK_WORDS = 500_000
LEAST = 0.5
LEAST_WORDS = 6
#: All trigrams of an item of up to so many words are seeds: an edit leaves it no five words in a row.
ALL_SEEDS = 12
#: Of items of six to eight words a larger share has to align.
SHORT, SHORT_LEAST = 8, 0.75
#: So many words, net of edits, are a leak however long the item is.
ENOUGH = 30
MATCH, MISMATCH, GAP = 2, -1, -1
MARGIN = 0.5
LEAKS = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment (Smith-Waterman): score, and where it ends in the passage.

    Row by row; gaps along the passage are a running maximum, so a row is a few vector operations.
    """
    n = len(passage)
    along = np.arange(n + 1, dtype=np.int32) * -GAP
    row = np.zeros(n + 1, dtype=np.int32)
    best, end = 0, -1
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH).astype(np.int32)
        new = np.zeros(n + 1, dtype=np.int32)
        np.maximum(row[:-1] + step, row[1:] + GAP, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + along) - along
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at - 1
    return best, end


def needed_words(length: int) -> float:
    """How many words, less those that edits cost, have to align with an item, or a piece of one, of so many words."""
    if length <= SHORT:
        return length if length < LEAST_WORDS else SHORT_LEAST * length
    return min(max(LEAST * length, LEAST_WORDS), ENOUGH)


def segments(words: list[bytes]) -> list[list[bytes]]:
    """Overlapping pieces of a long item; a short one is a piece itself. Fewer words than a gram give none."""
    if len(words) < GRAM:
        return []
    return [words[i : i + SEGMENT] for i in range(0, max(1, len(words) - (SEGMENT - STEP)), STEP)]


class Block:
    """Segments of some items, with their seeds."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.words = [], []
        for item_id, text in items:
            for piece in segments(words_of(text)):
                self.items.append(item_id)
                self.words.append(word_hashes(piece))
        self.grams = [gram_hashes(w, GRAM) for w in self.words]
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.grams]))
        self.seeds = self.known[:0]
        self.places: dict[int, list[tuple[int, int]]] = {}

    def held(self, grams: np.ndarray) -> np.ndarray:
        """Numbers of the known grams that a document holds."""
        at = np.searchsorted(self.known, grams)
        at[at == len(self.known)] = 0
        return np.unique(at[self.known[at] == grams]) if len(self.known) else at[:0]

    def choose_seeds(self, documents: np.ndarray) -> None:
        """``documents``: how many documents hold each known gram."""
        places = defaultdict(set)
        for s, grams in enumerate(self.grams):
            rarity = documents[np.searchsorted(self.known, grams)]
            width = WINDOW if len(self.words[s]) > ALL_SEEDS else 1
            for start in range(max(1, len(grams) - width + 1)):
                window = range(start, min(start + width, len(grams)))
                seed = min(window, key=lambda i: (rarity[i], grams[i]))
                places[int(grams[seed])].add((s, seed))
        self.places = {gram: sorted(where) for gram, where in places.items()}
        self.seeds = np.array(sorted(self.places), dtype=np.uint64)

    def leaks(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """Items that a text holds: item, score, first and last word of the best place."""
        words = word_hashes(words_of(text))
        if len(words) < GRAM or not len(self.seeds):
            return []
        grams = gram_hashes(words, GRAM)
        at = np.searchsorted(self.seeds, grams)
        at[at == len(self.seeds)] = 0
        near = defaultdict(list)
        for place in np.flatnonzero(self.seeds[at] == grams).tolist():
            for segment, start in self.places[int(grams[place])]:
                near[segment].append(place - start)
        best: dict[int, tuple[float, int, int]] = {}
        for segment, starts in near.items():
            item = self.words[segment]
            for first, last in self._regions(sorted(starts), len(item), len(words)):
                found = self._judge(item, words[first:last])
                if found and found[0] > best.get(self.items[segment], (0.0,))[0]:
                    best[self.items[segment]] = (found[0], first + found[1], first + found[2])
        return [(item, *where) for item, where in sorted(best.items(), key=lambda x: str(x[0]))]

    @staticmethod
    def _regions(starts: list[int], length: int, words: int) -> Iterator[tuple[int, int]]:
        """Parts of the document to align; those that overlap are one."""
        slack = int(length * MARGIN) + GRAM
        first = last = None
        for start in starts:
            low, high = max(0, start - slack), min(words, start + length + slack)
            if last is not None and low <= last:
                last = max(last, high)
                continue
            if last is not None:
                yield first, last
            first, last = low, high
        yield first, last

    @staticmethod
    def _judge(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int] | None:
        needed = needed_words(len(item))
        if np.isin(item, passage).sum() < needed:
            return None
        score, end = align(item, passage)
        if score < MATCH * needed:
            return None
        _, back = align(item[::-1], passage[end::-1])
        return score / (MATCH * len(item)), end - back, end


def _holding(df: DataFrame, text_column: str, block: Block) -> np.ndarray:
    """How many documents hold each known gram; a task sends one row per gram it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(block.known), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                totals[block.held(gram_hashes(word_hashes(words_of(text.as_py())), GRAM))] += 1
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(totals[met], pa.int64())], ["gram", "n"])

    counts = df.select(text_of(text_column).alias("text")).mapInArrow(count, "gram bigint, n bigint")
    out = np.zeros(len(block.known), dtype=np.int64)
    for gram, n in counts.groupBy("gram").agg(F.sum("n")).collect():
        out[gram] = n
    return out


def distinct_texts(benchmark: DataFrame, item_column: str, item_text_column: str) -> tuple[DataFrame, DataFrame]:
    """The texts of all items, each once, as ``text_id, text``, and which items have them, ``text_id, item_id``."""
    items = benchmark.select(F.col(f"`{item_column}`").cast("bigint").alias("item_id"), text_of(item_text_column).alias("text"))
    texts = settle(items.select("text").distinct().withColumn("text_id", F.monotonically_increasing_id()))
    return texts, items.join(texts, "text").select("text_id", "item_id").distinct()


def blocks(docs: DataFrame, texts: DataFrame, text_column: str) -> Iterator[Block]:
    """The benchmark's texts in blocks of about BLOCK_WORDS words, their seeds chosen by all documents."""
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-size // (BLOCK_WORDS * 6)) or 1
    for number in range(count):
        rows = texts.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == number).select("text_id", "text").collect()
        block = Block(sorted(map(tuple, rows)))
        block.choose_seeds(_holding(workers(docs), text_column, block))
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text"
) -> DataFrame:
    """Documents that hold benchmark items: ``doc_id, item_id, score, first_word, last_word``.

    A row per document and item whose best alignment reaches half of a perfect one, and six words (all words
    of an item of three to five, three quarters of one of six to eight), or thirty words of a longer item. Words are runs of letters and digits in lower case; ``first_word`` and
    ``last_word`` number them from 0. Items of fewer than three words, and null or empty texts on either
    side, take no part. Items with equal text each get their rows; a repeated document gives repeated
    rows, a repeated item row none. Long texts are read whole, long items in overlapping segments, of which
    one holds any passage of up to 64 words whole. A null id stays null. Empty tables give an empty result. Equal items are
    looked for once.
    """
    texts, names = distinct_texts(benchmark, item_column, item_text_column)

    def leaks_in(block: Block) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d.as_py(), *leak) for d, t in zip(batch.column(0), batch.column(1), strict=True) for leak in block.leaks(t.as_py())]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in LEAKS.split(", ")])

        return docs.select(F.col(f"`{id_column}`").cast("bigint"), text_of(text_column)).mapInArrow(find, LEAKS)

    found = reduce(DataFrame.unionByName, map(leaks_in, blocks(docs, texts, text_column)))
    return join_small(found.withColumnRenamed("item_id", "text_id"), settle(names), ["text_id"]).select(*[c.split()[0] for c in LEAKS.split(", ")])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """The documents without a leak, in all their columns; the rules are those of ``find_leaks``."""
    place = [c.lower() for c in docs.columns].index(text_column.lower())
    texts = distinct_texts(benchmark, item_column, item_text_column)[0]

    def clean(block: Block):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not block.leaks(t.as_py()) for t in batch.column(place)], pa.bool_()))

        return keep

    return reduce(lambda df, block: df.mapInArrow(clean(block), docs.schema), blocks(docs, texts, text_column), docs)
