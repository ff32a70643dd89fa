"""Token ids as binary files: one array of ids, document boundaries as Elias-Fano numbers beside it.

A part is two files. ``<part>.ids`` holds the ids of its documents one after another, two bytes each where
the vocabulary allows it, else four, low byte first. ``<part>.index`` holds a header and the documents'
ids and ends. Parts follow each other in ascending document id; a manifest names those that count.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.llm.common import text_of, workers
from gaugeloft.llm.elias_fano import EliasFano
from gaugeloft.storage import filesystem_of

MAGIC = b"GLTOK1"
HEADER = "<6sBBqQ"
CACHED_WORDS = 600_000
LONG_WORD = 64
BLOCK = 256
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
PLAIN = re.compile(f"[!-~{LETTERS}]+")
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
MANIFEST = "part int, name string, n_docs bigint, n_ids bigint"
TOKENS = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids_crc32 bigint"


class WordTokenizer:
    """Encodes texts word by word, remembering words and their parts.

    Holds for tokenizers that lower case, drop white space and never join across it, as word-end vocabularies
    do. Words come between ASCII white space. A plain word (visible ASCII and Latin letters) is cut into
    its parts as the tokenizer's own pattern cuts it, and the parts go to its model; any other word goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.model, self.bytes = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(self.width, "little") for i in ids])

    def _plain(self, word: str) -> bytes:
        out = []
        for part in PARTS.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                seen = part if part.isascii() else self.bytes.pre_tokenize_str(part)[0][0]
                ids = self._packed([t.id for t in self.model.tokenize(seen)])
                if len(part) <= LONG_WORD:
                    self.parts[part] = ids
            out.append(ids)
        return b"".join(out)

    def _encode(self, words: list[bytes]) -> None:
        rest = []
        for word in words:
            text = word.decode("utf-8", "replace")
            if PLAIN.fullmatch(text) and "<|" not in text:
                self.known[word] = self._plain(text)
            else:
                rest.append((word, text))
        for (word, _), e in zip(rest, self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False), strict=True):
            self.known[word] = self._packed(e.ids)

    def _words(self, words: list[bytes]) -> bytes:
        known = self.known
        missing = {w for w in words if w not in known}
        if missing:
            if len(known) + len(missing) > CACHED_WORDS:
                known.clear()
                missing = set(words)
            if len(self.parts) > CACHED_WORDS:
                self.parts.clear()
            self._encode(list(missing))
        out = b"".join([known[w] for w in words])
        for word in missing:
            if len(word) > LONG_WORD:
                del known[word]
        return out

    def text(self, text: str | None) -> bytes:
        """Ids of a text as bytes; a very long one in steps."""
        words = (text or "").encode("utf-8", "replace").split()
        step = CACHED_WORDS // 4
        return b"".join([self._words(words[i : i + step]) for i in range(0, len(words), step)])


@lru_cache(maxsize=2)
def tokenizer_at(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _writer(path: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_at(tokenizer)
        end = int(end_id).to_bytes(encoder.width, "little")
        system, folder = filesystem_of(path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        ids, nulls, ends, total = [], 0, [], 0
        out = None
        for batch in batches:
            for doc, text in zip(batch.column("id"), batch.column("text"), strict=True):
                if out is None:
                    out = system.open_output_stream(f"{folder}/{name}.ids")
                data = encoder.text(text.as_py())
                out.write(data + end)
                total += len(data) // encoder.width + 1
                ends.append(total)
                if doc.as_py() is None:
                    nulls += 1
                else:
                    ids.append(doc.as_py())
        if out is None:
            return
        out.close()
        least = ids[0] if ids else 0
        numbers = EliasFano.encode(np.array(ids, dtype=np.int64).view(np.uint64) - np.array(least, dtype=np.int64).view(np.uint64))
        with system.open_output_stream(f"{folder}/{name}.index") as index:
            index.write(struct.pack(HEADER, MAGIC, 1, encoder.width, least, nulls) + numbers.to_bytes() + EliasFano.encode(np.array(ends, dtype=np.uint64)).to_bytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "n_docs": [len(ends)], "n_ids": [total]})

    return write


class TokenFile:
    """One part: any document's ids, found through its boundaries."""

    def __init__(self, path: str, name: str):
        self.system, folder = filesystem_of(path)
        self.file = f"{folder}/{name}.ids"
        with self.system.open_input_file(f"{folder}/{name}.index") as index:
            data = index.read()
        magic, _, self.width, self.least, self.nulls = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.numbers, rest = EliasFano.from_bytes(data[struct.calcsize(HEADER) :])
        self.ends, _ = EliasFano.from_bytes(rest)

    def __len__(self) -> int:
        return self.ends.count

    def doc_ids(self, start: int, count: int) -> list[int | None]:
        known = self.numbers.run(max(0, start - self.nulls), start + count - max(start, self.nulls))
        missing = min(max(0, self.nulls - start), count)
        least = np.array(self.least, dtype=np.int64).view(np.uint64)
        return [None] * missing + (known + least).view(np.int64).tolist()

    def bounds(self, start: int, count: int) -> np.ndarray:
        """Begin of document ``start``, then the ends of it and those after it."""
        first = self.ends.select(start - 1) if start else 0
        return np.concatenate([np.array([first], dtype=np.uint64), self.ends.run(start, count)])

    def blocks(self, count: int = BLOCK) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """Documents in order: number of the first, bounds, ids of each."""
        with self.system.open_input_file(self.file) as ids:
            for start in range(0, len(self), count):
                bounds = self.bounds(start, count).astype(np.int64)
                ids.seek(int(bounds[0]) * self.width)
                data = np.frombuffer(ids.read(int(bounds[-1] - bounds[0]) * self.width), dtype=f"<u{self.width}")
                yield start, bounds, np.split(data, bounds[1:-1] - bounds[0])

    def document(self, i: int) -> np.ndarray:
        first, last = self.bounds(i, 1).tolist()
        with self.system.open_input_file(self.file) as ids:
            ids.seek(first * self.width)
            return np.frombuffer(ids.read((last - first) * self.width), dtype=f"<u{self.width}")


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Writes all texts below ``path`` (on shared storage) and returns the manifest: ``part, name, n_docs, n_ids``.

    Documents stand in ascending id, nulls first, then by a hash of the text; repeated rows follow each
    other. A null or empty text is the end id alone. Range partitions hold the order, also within one id,
    and ids are written as they come, so a task holds a few documents and eight bytes for each boundary.
    Every attempt of a task writes files of its own name, and the manifest has only those of finished
    tasks. An empty table gives an empty manifest.
    """
    system, folder = filesystem_of(path)
    system.create_dir(f"{folder}/data", recursive=True)
    rows = workers(df).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text_of(text_column).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    ordered.mapInArrow(_writer(f"{path}/data", tokenizer, end_id), MANIFEST).write.parquet(f"{path}/manifest")
    return df.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, per document: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over the ids as four bytes each, low
    byte first. The manifest has a row per part; only these reach the driver.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    starts, total = [], 0
    for part, ids in sorted(map(tuple, manifest.select("part", "n_ids").collect())):
        starts.append((part, total))
        total += ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(f"{path}/data", row["name"])
                for start, bounds, documents in file.blocks():
                    n = len(documents)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(file.doc_ids(start, n), pa.int64()), "part": pa.array([row["part"]] * n, pa.int32()), "local_start": pa.array(bounds[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()), "ids_crc32": pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in documents], pa.int64()),
                    })

    spread = manifest.repartition(max(1, len(starts))) if len(starts) > 1 else manifest
    documents = workers(spread).mapInArrow(read, TOKENS)
    before = spark.createDataFrame(starts, "part int, before bigint")
    joined = documents.join(F.broadcast(before), "part")
    return joined.select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
