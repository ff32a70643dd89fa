"""Ranked lexical search over hashed max-sketches.

A document's sketch has, for each of 65,536 coordinates, the largest count of its terms that hash there; coordinates
without terms are not stored. A term's impact rises with its count, so the impact of a coordinate's count
is the largest impact of any term there, and a query's weights, looked up in the sketches, add up to an upper
bound of its score. Sketches do not depend on queries or on the corpus; an index of them, with the number of
documents for each term, is written in one pass over the texts and serves any queries.

A search goes down the bounds: the documents with the best bounds of each query get their exact scores, from
their texts, and the k-th of these is the threshold; documents whose bounds reach it get theirs too.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeloft.llm.common import text_of, workers
from gaugeloft.operators.joins import fits_broadcast
from gaugeloft.session import settle

COORDINATES = 1 << 16
#: Characters of queries that are searched for at once; their terms and weights go to all tasks.
BLOCK_CHARS = 4_000_000
#: Bounds, and parts of bounds, that a task holds at once.
CELLS = 1 << 20
FLUSH = 100_000
DOCUMENTS = 1000
FIRST = 4
LAST_ID = (1 << 63) - 1
INDEX = "doc_id bigint, text_hash bigint, n bigint, coordinates array<int>, counts array<int>, term binary, documents bigint"
BOUNDS = "query int, doc_id bigint, text_hash bigint, bound bigint"
SCORES = "query int, doc_id bigint, score bigint"

#: Letters and digits of ASCII, in lower case, and all other characters belong to terms; the rest parts them.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of other characters, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERMS).split()


def coordinate(term: bytes) -> int:
    return zlib.crc32(term) % COORDINATES


class _Coordinates(dict):
    """Known terms' coordinates; starts anew when full."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= FLUSH:
            self.clear()
        found = self[term] = coordinate(term)
        return found


def sketch(counts: Counter[bytes], places: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates, rising, and the largest count of the terms at each."""
    at = np.fromiter(map(places.__getitem__, counts), dtype=np.int32, count=len(counts))
    n = np.fromiter(counts.values(), dtype=np.int32, count=len(counts))
    order = np.argsort(at, kind="stable")
    at, n = at[order], n[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return (at[first], np.maximum.reduceat(n, first)) if len(first) else (at, n)


def _index_batch(rows: list[tuple], held: Counter[bytes] | None) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    ints = pa.list_(pa.int32())
    terms, documents = (list(held), list(held.values())) if held else ([], [])
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    gap, tail = [None] * len(terms), [None] * len(rows)
    types = [pa.int64(), pa.int64(), pa.int64(), ints, ints]
    arrays = [pa.array([*c, *gap], t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([*tail, *terms], pa.binary()), pa.array([*tail, *documents], pa.int64())], names)


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document that has terms, and rows that count documents per term, combined within the task."""
    held: Counter[bytes] = Counter()
    places = _Coordinates()
    for batch in batches:
        rows = []
        for doc, key, text in zip(*(batch.column(c) for c in ("doc_id", "text_hash", "text")), strict=True):
            counts = Counter(terms_of(text.as_py()))
            if counts:
                held.update(counts.keys())
                rows.append((doc.as_py(), key.as_py(), counts.total(), *sketch(counts, places)))
            if len(rows) >= DOCUMENTS or len(held) >= FLUSH:
                yield _index_batch(rows, None)
                rows = []
            if len(held) >= FLUSH:
                yield _index_batch([], held)
                held.clear()
        yield _index_batch(rows, None)
    yield _index_batch([], held)


@dataclass(frozen=True)
class Block:
    """Queries that are searched for at once: for each its terms' weights, and where to look them up."""

    weights: list[dict[bytes, int]]
    documents: int
    terms: int

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each coordinate, from where to where its entries are; the entries' queries and weights."""
        entries = sorted((coordinate(t), q, w) for q, found in enumerate(self.weights) for t, w in found.items())
        at, queries, weights = (np.array(c, dtype=np.int64) for c in (zip(*entries, strict=True) if entries else ([], [], [])))
        return np.searchsorted(at, np.arange(COORDINATES + 1)), queries, weights

    def spread(self, n: int) -> int:
        """What a document's length adds to its counts."""
        return 100 - 90 + 90 * n * self.documents // self.terms

    def score(self, query: int, counts: Counter[bytes], n: int) -> int:
        spread = 8 * self.spread(n)
        weights = self.weights[query]
        small, large = (weights, counts) if len(weights) < len(counts) else (counts, weights)
        return sum(weights[t] * (1_000_000_000 * counts[t] // (1000 * counts[t] + spread)) for t in small if t in large)


def bounds_of(batch: pa.RecordBatch, block: Block, postings: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Upper bounds, documents by queries, some documents at a time, with the number of the first."""
    starts, queries, weights = postings
    offsets = batch.column("coordinates").offsets.to_numpy()
    values, counts = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("coordinates", "counts"))
    spread = np.array([8 * block.spread(n) for n in batch.column("n").to_pylist()], dtype=np.int64)
    many = len(block.weights)
    asked = starts[1:] - starts[:-1]
    sums = np.concatenate([[0], np.cumsum(asked[values])])[offsets - offsets[0]]
    last = 0
    while last < batch.num_rows:
        first = last
        enough = np.searchsorted(sums, sums[first] + CELLS, side="right") - 1
        last = int(max(first + 1, min(batch.num_rows, enough, first + CELLS // max(1, many))))
        part = slice(offsets[first] - offsets[0], offsets[last] - offsets[0])
        doc = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
        at, tf = values[part], counts[part]
        met = np.flatnonzero(asked[at])
        doc, at, tf = doc[met], at[met], tf[met]
        entries = asked[at]
        impact = 1_000_000_000 * tf // (1000 * tf + spread[first:last][doc])
        entry = np.repeat(starts[at] - np.cumsum(entries) + entries, entries) + np.arange(entries.sum())
        cell = np.repeat(doc, entries) * many + queries[entry]
        # Sums of whole numbers below 2**53 are exact in doubles.
        found = np.bincount(cell, weights=(np.repeat(impact, entries) * weights[entry]).astype(float), minlength=(last - first) * many)
        yield first, found.reshape(last - first, many)


def _bounder(block: Block, k: int, reach: dict[int, tuple[int, int]] | None):
    """Without ``reach`` a task's best ``k`` documents of each query, by bound; else all that may reach it.

    ``reach`` has the k-th best score so far and its id: an equal bound counts only with an id up to that.
    """
    names = [c.split()[0] for c in BOUNDS.split(", ")]
    many = len(block.weights)
    least = np.array([reach[q][0] if reach and q in reach else 0 for q in range(many)], dtype=float)
    last = np.array([reach[q][1] if reach and q in reach else LAST_ID for q in range(many)], dtype=np.int64)

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        ids = pa.array(rows[:, 1], pa.int64(), mask=rows[:, 1] == LAST_ID)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0].astype(np.int32)), ids, pa.array(rows[:, 2]), pa.array(rows[:, 3])], names)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = block.postings()
        best, floor = np.zeros((0, 4), dtype=np.int64), least.copy()
        for batch in batches:
            ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy()
            keys = batch.column("text_hash").to_numpy()
            for first, found in bounds_of(batch, block, postings):
                doc, query = np.nonzero((found >= np.maximum(floor, 1)))
                value, at = found[doc, query], first + doc
                reached = (value > floor[query]) | (ids[at] <= last[query]) if reach is not None else slice(None)
                rows = np.column_stack([query, ids[at], keys[at], value.astype(np.int64)])[reached]
                if reach is not None:
                    if len(rows):
                        yield emit(rows)
                    continue
                best = np.vstack([best, rows])
                best = best[np.lexsort((best[:, 2], best[:, 1], -best[:, 3], best[:, 0]))]
                place = np.arange(len(best)) - np.searchsorted(best[:, 0], best[:, 0])
                best = best[place < k]
                full = best[place[place < k] == k - 1]
                floor[full[:, 0]] = full[:, 3]
        if reach is None and len(best):
            yield emit(best)

    return bound


def _scorer(block: Block):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, queries in zip(*(batch.column(c) for c in ("doc_id", "text", "queries")), strict=True):
                counts = Counter(terms_of(text.as_py()))
                n = counts.total()
                scored = ((q, doc.as_py(), block.score(q, counts, n)) for q in queries.as_py())
                rows += [r for r in scored if r[2] > 0]
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["query", "doc_id", "score"])

    return score


def _first(rows: DataFrame, by: str, k: int) -> DataFrame:
    """Each query's best ``k`` rows, numbered in ``rank``; equal ones by id, null ids last."""
    order = W.partitionBy("query").orderBy(F.desc(by), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class LexicalIndex:
    """Sketches of all documents that have terms, and documents per term, in tables on shared storage.

    Null and empty texts have no terms. Null ids and repeated rows are rows of their own. Long texts are taken whole.
    """

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
        text = text_of(text_column)
        self.docs = workers(docs).select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
        rows = settle(self.docs.mapInArrow(_indexer, INDEX))
        self.sketches = rows.filter("term IS NULL").select("doc_id", "text_hash", "n", "coordinates", "counts")
        held = rows.filter("term IS NOT NULL").groupBy("term").agg(F.sum("documents").alias("documents"))
        self.held = settle(held)
        self.documents, self.terms = self.sketches.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def block(self, texts: list[str]) -> Block:
        """Queries with their terms' weights. Terms that no document has add nothing to any score."""
        wanted = {t for text in texts for t in terms_of(text)}
        spark = self.held.sparkSession
        asked = spark.createDataFrame([(bytearray(t),) for t in sorted(wanted)], "term binary")
        held = {bytes(r["term"]): r["documents"] for r in self.held.join(asked, "term", "left_semi").collect()}
        weight = {t: math.floor(1000 * math.log((2 * self.documents + 2) / (2 * n + 1))) for t, n in held.items()}
        return Block([{t: weight[t] for t in set(terms_of(text)) if t in weight} for text in texts], self.documents, max(1, self.terms))

    def search(self, texts: list[str], k: int) -> DataFrame:
        """``query, rank, doc_id, score``: the ``k`` best documents of each text, which ``query`` numbers."""
        block = self.block(texts)
        first = _first(self.sketches.mapInArrow(_bounder(block, FIRST * k, None), BOUNDS), "bound", FIRST * k)
        tried = _first(self._scores(settle(first.drop("rank")), block), "score", k)
        reach = {r["query"]: (r["score"], LAST_ID if r["doc_id"] is None else r["doc_id"]) for r in tried.filter(F.col("rank") == k).collect()}
        hopeful = settle(self.sketches.mapInArrow(_bounder(block, k, reach), BOUNDS))
        return _first(self._scores(hopeful, block), "score", k).select("query", "rank", "doc_id", "score")

    def _scores(self, pairs: DataFrame, block: Block) -> DataFrame:
        """Exact scores of pairs of a query and a document, from the documents' texts."""
        asked = pairs.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("query")).alias("queries"))
        asked = asked.withColumnsRenamed({"doc_id": "asked_id", "text_hash": "asked_hash"})
        if fits_broadcast(asked):
            asked = F.broadcast(asked)
        same: Column = F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("text_hash") == F.col("asked_hash"))
        return self.docs.join(asked, same).select("doc_id", "text", "queries").mapInArrow(_scorer(block), SCORES)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text"
) -> DataFrame:
    """The ``k`` best documents for each item: ``item_id, rank, doc_id, score``, fewer where fewer score above 0.

    A score sums weight * impact over an item's distinct terms; rare terms weigh more, impacts rise with a term's
    count and fall with a document's length. Equal scores go to the smaller id, null ids last. Items
    without terms, null ones too, find nothing. Repeated documents each take a rank, repeated items are each
    answered; a null item id stays null. Empty tables give no rows. Items come in blocks of about four
    million characters, by hash; a block's terms go to all tasks.
    """
    index = LexicalIndex(docs, id_column, text_column)
    asked = items.select(F.col(f"`{item_column}`").cast("bigint").alias("item_id"), text_of(item_text_column).alias("text"))
    asked = settle(asked.withColumn("row", F.monotonically_increasing_id()))
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-size // BLOCK_CHARS) or 1

    def answers(number: int) -> DataFrame:
        rows = asked.filter(F.pmod(F.xxhash64("row"), F.lit(count)) == number).orderBy("row").collect()
        found = index.search([r["text"] for r in rows], k)
        names = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "query int, item_id bigint")
        return found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")

    return reduce(DataFrame.unionByName, map(answers, range(count)))
