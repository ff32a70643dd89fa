"""Best-fit packing of tokenised documents into sequences, planned on the histogram of lengths.

Documents longer than a sequence are cut; what comes out are pieces. Their lengths are counted, and best-fit
runs on the counts: sequences that have the same room left form one group, of which as many as needed take a
length at once. The plan is a short table of runs (so many pieces of a length go to consecutive sequences
at one offset), whose size hangs on the capacity alone. Every piece has a rank within its length and finds
its place by joining on that rank.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gaugeloft.llm.common import text_of, workers
from gaugeloft.session import settle

CAPACITY = 1024
#: Pieces per group that ranks them within their lengths.
GROUP = 50_000
CACHED_WORDS = 600_000
LONG_WORD = 64
PIECES = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
RUNS = "length bigint, first_rank bigint, count bigint, first_sequence bigint, offset bigint"

#: What surely is no white space: visible ASCII and Latin letters.
VISIBLE = "!-~\u00c0-\u024f"
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
UNCERTAIN = re.compile(f" (?![{VISIBLE}])")
CERTAIN = re.compile(f" (?=[{VISIBLE}])")
PLAIN = re.compile(f"[{VISIBLE}\n\r\t]*")
#: How byte-level vocabularies cut a plain word, a space before it or not.
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^ \n\r\t0-9{LETTERS}]+|[\n\r\t]+(?![^\n\r\t])|[\n\r\t]+")
#: The characters that stand for bytes: themselves where visible in Latin-1, else from 256 on, in order.
_hidden = [b for b in range(256) if b < 33 or 126 < b < 161 or b == 173]
BYTES = {b: 256 + i for i, b in enumerate(_hidden)}
SPACE = chr(BYTES[32])


class _Remembered(dict):
    """What ``encode`` gives, but for long keys. When full it starts anew, and takes over what is asked for again."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.before: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.encode(key)
        if len(key) <= LONG_WORD:
            if len(self) >= CACHED_WORDS:
                self.before = dict(self)
                self.clear()
            self[key] = found
        return found


class ByteTokenizer:
    """Encodes texts with a byte-level vocabulary, remembering words.

    A token never reaches from before a space into a visible character after it, so a text may be cut there
    and every word, with its space, encoded by itself. A word of visible ASCII and Latin letters is cut into
    its parts as the tokenizer's pattern cuts it, and the parts go to its model; any other word goes through the whole
    tokenizer. So does a text that holds a special token, and every text if the tokenizer normalizes or
    cuts in another way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cut = self.tokenizer.pre_tokenizer
        usual = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True, trim_offsets=True)
        self.by_word = cut is not None and cut.__getstate__() == usual.__getstate__() and self.tokenizer.normalizer is None
        self.model = self.tokenizer.model
        self.words, self.parts = _Remembered(self._word), _Remembered(self._ids)

    def _packed(self, ids: list[int]) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder != "little":
            packed.byteswap()
        return packed.tobytes()

    def _ids(self, part: str) -> bytes:
        seen = part.encode().decode("latin-1").translate(BYTES)
        return self._packed([t.id for t in self.model.tokenize(seen)])

    def _word(self, word: str) -> bytes:
        """Ids of a word with a space before it."""
        if word.isalpha() and word.isascii():
            return self._packed([t.id for t in self.model.tokenize(SPACE + word)])
        if not PLAIN.fullmatch(word):
            return self._whole(f" {word}")
        return b"".join([self.words[part[1:]] if part[0] == " " and part != f" {word}" and part[1:].isalpha() else self.parts[part] for part in PARTS.findall(f" {word}")])

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def text(self, text: str | None) -> np.ndarray:
        """The ids of a text."""
        text = text or ""
        if not self.by_word or any(s in text for s in self.special):
            return np.frombuffer(self._whole(text), dtype=f"<u{self.width}")
        first, *rest = CERTAIN.split(text) if UNCERTAIN.search(text) else text.split(" ")
        return np.frombuffer(self._whole(first) + b"".join(map(self.words.__getitem__, rest)), dtype=f"<u{self.width}")


@lru_cache(maxsize=2)
def tokenizer_at(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def cuts(total: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin, and its end; only the first may be shorter than the capacity."""
    first = (total - 1) % capacity + 1
    return [0, *range(first, total + 1, capacity)]


def _cutter(tokenizer: str, end_id: int, capacity: int):
    names = [c.split()[0] for c in PIECES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_at(tokenizer)
        for batch in batches:
            rows = []
            for row, doc, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text")), strict=True):
                ids = np.append(encoder.text(text.as_py()).astype("<u4"), np.uint32(end_id))
                places = cuts(len(ids), capacity)
                for piece, (start, end) in enumerate(zip(places, places[1:], strict=False)):
                    data = ids[start:end]
                    rows.append((row.as_py(), doc.as_py(), piece, start, end - start, zlib.crc32(data.tobytes()), data.astype(f"<u{encoder.width}").tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return cut


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents as pieces of at most ``capacity`` ids: ``row, doc_id, piece, start, length, ids_crc32, ids``.

    ``row`` tells repeated documents apart. Every document ends with ``end_id``, a null or empty text is that
    alone. ``ids`` are two bytes each where the vocabulary allows it, else four, low byte first;
    ``ids_crc32`` is over four bytes each. The rows are fixed in a table.
    """
    rows = workers(docs).select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text_of(text_column).alias("text"))
    return settle(rows.mapInArrow(_cutter(tokenizer, end_id, capacity), PIECES))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit over counts, longest first: runs ``length, first_rank, count, first_sequence, offset``.

    Every piece goes to a sequence with the least room that holds it. A run sends the pieces of a length with
    ranks from ``first_rank`` on to consecutive sequences, one each, at the same offset. A step either uses up
    a length or a group of sequences, and only the former leaves one group more, so there are a few
    runs per length, whatever the counts.
    """
    runs, sequences = [], 0
    groups: list[tuple[int, int, int]] = []  # room, first sequence, how many; by room
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} ids does not fit into {capacity}")
        rank, left = 0, histogram[length]
        while left > 0:
            at = bisect_left(groups, (length, -1, -1))
            if at < len(groups):
                room, first, many = groups.pop(at)
            else:
                fit = capacity // length
                room, first, many = capacity, sequences, -(-left // fit)
                sequences += many
            used = min(left, many)
            runs.append((length, rank, used, first, capacity - room))
            if used < many:
                insort(groups, (room, first + used, many - used))
            if room > length:
                insort(groups, (room - length, first, used))
            rank, left = rank + used, left - used
    return runs


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Adds ``rank`` within ``length``, from 0. Pieces are dealt into groups of about 50,000 by hash, so that a length of
    very many pieces spans many tasks; what goes before a group is summed over one row per length and group."""
    groups = -(-total // GROUP) or 1
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    before = W.partitionBy("length").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "group").agg(F.count("*").alias("n")).select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "group").orderBy("row", "piece")) - 1
    return dealt.withColumn("within", within).join(counts, ["length", "group"]).withColumn("rank", F.col("before") + F.col("within")).drop("group", "before", "within")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``row, piece, length``; other columns stay.

    The histogram has at most ``capacity`` rows, the plan a few runs for each, so both may pass the driver and the plan
    may be broadcast.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = pieces.sparkSession.createDataFrame(plan(histogram, capacity), RUNS).withColumnRenamed("length", "run_length")
    taken: Column = (F.col("run_length") == F.col("length")) & F.col("rank").between(F.col("first_rank"), F.col("first_rank") + F.col("count") - 1)
    placed = ranked(pieces, sum(histogram.values())).join(F.broadcast(runs), taken)
    return placed.withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank")).drop("rank", "run_length", "first_rank", "count", "first_sequence")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents packed into sequences of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids``.

    One row per piece. Documents of more ids are cut, the first piece being the shorter one; others stay
    whole. A sequence's pieces follow each other without gaps. Null and empty texts are one id; null ids stay
    null; repeated rows are packed each for itself; an empty table gives no rows. Texts are tokenised
    whole, once.
    """
    return place(pieces_of(docs, tokenizer, end_id, capacity, id_column, text_column), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id, n_ids, ids, doc_ids, lengths``, pieces in order of their offset.

    A sequence has at most as many pieces as ids, so none outgrows its row.
    """
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    joined = packed.groupBy("sequence_id").agg(held.alias("p"), F.sum("length").alias("n_ids"))
    ids = F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    return joined.select("sequence_id", "n_ids", ids.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))
