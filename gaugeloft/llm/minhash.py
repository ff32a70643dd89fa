"""Near-duplicates by b-bit MinHash.

Every distinct shingle set is signed with the minima of 224 hash functions. Bands of five minima put
similar sets into common buckets; of each minimum, mixed once more, only four bits are kept, packed into longs,
and the number of equal groups of bits, corrected for chance agreement, estimates the similarity of a
candidate pair. Pairs that may reach the limit are confirmed on their full sets.

A pair at the limit of 0.8 misses all 44 bands with probability 3e-8, and the estimate turns it away
with probability of about 1e-6, as far as the hash functions are independent. Pairs of sets with similarity s meet with probability 44 * s**5 or less,
so for corpora of more than about 10**8 documents choose more rows and hashes: they cost time per
shingle, not space per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloft.llm.common import fresh, mixed, put, short_batches, text_of, workers
from gaugeloft.llm.components import components
from gaugeloft.llm.shingles import shingle_set
from gaugeloft.session import settle

HASHES = 224
ROWS = 5
BITS = 4
CHUNK = 2048
MARGIN = 4.9
STARS = 2
#: Bits of a set's bitmap.
BITMAP = 2048
DIGEST = 10**38

KEY = pa.decimal128(38, 0)
SIGNED = "id bigint, text_key decimal(38,0), n_shingles bigint, set_key decimal(38,0), bands array<bigint>, bits array<bigint>"
_draw = np.random.default_rng(0x5EED)
MULTIPLIERS = _draw.integers(0, 1 << 31, (HASHES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SUMMANDS = _draw.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32)
SEEDS = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over the set, in pieces that stay in the processor's cache."""
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), CHUNK):
        values = MULTIPLIERS * x[None, start : start + CHUNK]
        values += SUMMANDS
        np.minimum(low, values.min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One long per band of five minima."""
    bands = low[: HASHES // ROWS * ROWS].reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(len(bands), dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, j])
    return key.view(np.int64)


def scrambled(low: np.ndarray) -> np.ndarray:
    """The minima, mixed differently for each hash function (the finaliser of MurmurHash3).

    Low bits of a * x + b hang on the low bits of x alone, so that those of a small set's few elements would
    agree, or differ, under all functions at once. The bits kept of a mixed minimum are independent.
    """
    x = low ^ SEEDS
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def packed_bits(low: np.ndarray) -> np.ndarray:
    """Four bits of each mixed minimum, sixteen to a long."""
    nibbles = (scrambled(low) & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return (nibbles[0::2] | nibbles[1::2] << 4).view(np.int64)


def set_key(shingles: np.ndarray) -> Decimal:
    return Decimal(xxhash.xxh3_128_intdigest(shingles.tobytes()) % DIGEST)


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, bands, bits = [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), size)
                counts.append(len(shingles))
                low = minima(shingles) if len(shingles) else None
                keys.append(set_key(shingles) if len(shingles) else None)
                bands.append(None if low is None else band_keys(low))
                bits.append(None if low is None else packed_bits(low))
            longs = pa.list_(pa.int64())
            columns = [batch.column("id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(keys, KEY), pa.array(bands, longs), pa.array(bits, longs)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "n_shingles", "set_key", "bands", "bits"])

    return sign


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Sets the bit that each shingle hashes to, 64 to a long."""
    held = np.zeros(BITMAP, dtype=np.uint8)
    held[(shingles % np.uint64(BITMAP)).astype(np.int64)] = 1
    return np.packbits(held).view(np.int64)


def _shingler(size: int):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), size) for text in batch.column("text")]
            longs = pa.list_(pa.int64())
            columns = [batch.column("set_key"), pa.array([s.view(np.int64) for s in sets], longs), pa.array([bitmap(s) for s in sets], longs)]
            yield pa.RecordBatch.from_arrays(columns, ["set_key", "shingles", "bitmap"])

    return shingle


def text_key(text: Column) -> Column:
    """Tells texts apart: 96 bits of two hashes as a number, which aggregates in place."""
    return F.xxhash64(text).cast("decimal(38,0)") * (1 << 32) + F.pmod(F.hash(text), F.lit(1 << 32))


def similarity_of_bits(a: str, b: str) -> Column:
    """Estimated similarity from the packed bits: equal groups, less those that agree by chance."""
    low = 0x1111111111111111

    def differing(i: int) -> Column:
        d = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for shift in (1, 2):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        return F.bit_count(d.bitwiseAND(F.lit(low)))

    unequal = reduce(lambda x, y: x + y, map(differing, range(HASHES * BITS // 64)))
    return ((1 - unequal / HASHES) - 2.0**-BITS) / (1 - 2.0**-BITS)


def most_in_common(a: str, b: str) -> Column:
    """The most shingles that two sets can share: every bit that only one bitmap has stands for a shingle that only
    one set has. Holds without exception, whatever hashes where."""
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.get(f"bitmap_{a}", F.lit(i)).bitwiseXOR(F.get(f"bitmap_{b}", F.lit(i)))) for i in range(BITMAP // 64)])
    return (F.col(f"n_{a}") + F.col(f"n_{b}") - apart) / 2


def lowest_estimate(percent: int) -> float:
    """What the estimate of a pair at the limit stays above, but for about one in a million."""
    s = percent / 100
    agree = s + (1 - s) / 2**BITS
    return s - MARGIN * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - 2.0**-BITS)


class NearDuplicates:
    """One run over a table of documents; ``rows`` has one row per document.

    Steps: sign every text; let equal sets be one class; find buckets with more than one class. In each
    bucket the class with the most company is the hub, and every other class is held against it; then, twice,
    a hub by hash against the classes of other components. What is left, classes of one bucket in different
    components, is held against each other, and those come out as pairs that sizes, bits and bitmaps leave a link
    possible for. So a bucket of copies costs about its size and not its square, a family of variants below the
    limit makes few pairs, and no candidate pair goes unjudged.
    """

    def __init__(self, docs: DataFrame, id_column: str, text_column: str, shingle: int, percent: int):
        self.size, self.percent = shingle, percent
        text = text_of(text_column)
        self.docs = short_batches(workers(docs)).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), text_key(text).alias("text_key"), text.alias("text"))
        self.signed = settle(self.docs.mapInArrow(_signer(shingle), SIGNED))
        known = self.signed.filter("set_key IS NOT NULL").groupBy("set_key")
        self.classes = settle(known.agg(F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")))

    def labels(self) -> DataFrame:
        """Component of each linked class, ``node, label``. Only links that still join components are looked for."""
        places = self.classes.select("set_key", F.explode("bands").alias("bucket"))
        shared = places.groupBy("bucket").agg(F.count("*").alias("company")).filter("company > 1")
        members = settle(places.join(shared, "bucket"))
        self.sets = self._sets(members)
        company = members.groupBy("set_key").agg((-F.sum("company")).alias("rank"))
        label = components(self._confirmed(self._hopeful(self._star(members.select("bucket", "set_key").join(company, "set_key")))))
        for salt in range(STARS + 1):
            apart = self._apart(members, label)
            if apart.isEmpty():
                break
            ranked = apart.withColumn("rank", F.xxhash64(F.lit(salt), "bucket", "set_key"))
            found = settle(self._confirmed(self._hopeful(self._star(ranked, "label")) if salt < STARS else self._crossing(apart)))
            if not found.isEmpty():
                label = components(label.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(found))
        return label

    @staticmethod
    def _star(ranked: DataFrame, apart_by: str = "set_key") -> DataFrame:
        """Pairs of each bucket's member of least ``rank`` with those that differ from it in ``apart_by``."""
        hub = F.struct("rank", "set_key", F.col(apart_by).alias("own"))
        hubs = ranked.groupBy("bucket").agg(F.min(hub).alias("hub")).select("bucket", F.col("hub.set_key").alias("a"), F.col("hub.own").alias("own"))
        pairs = ranked.join(hubs, "bucket").filter(F.col(apart_by) != F.col("own"))
        return pairs.select(F.least("a", "set_key").alias("a"), F.greatest("a", "set_key").alias("b")).distinct()

    @staticmethod
    def _apart(members: DataFrame, label: DataFrame) -> DataFrame:
        """Members, with their component, of buckets that hold more than one component."""
        labelled = members.select("bucket", "set_key").join(label.withColumnRenamed("node", "set_key"), "set_key", "left")
        labelled = labelled.withColumn("label", F.coalesce("label", "set_key"))
        mixed_buckets = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
        return settle(labelled.join(mixed_buckets, "bucket", "left_semi"))

    def _crossing(self, apart: DataFrame) -> DataFrame:
        """Pairs of one bucket and different components that a link is possible for, each once: ``a, b, n_a, n_b``.

        Sizes, bits and bitmaps must allow the link. A pair comes out of the first of the buckets it shares only.
        """
        signed = apart.join(self.classes.select("set_key", "n", "bits", "bands"), "set_key").join(self.sets.select("set_key", "bitmap"), "set_key")
        columns = ("set_key", "label", "n", "bits", "bands", "bitmap")
        left, right = (signed.select("bucket", *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")
        common = F.filter(F.zip_with("bands_a", "bands_b", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
        enough = most_in_common("a", "b") * (100 + self.percent) >= (F.col("n_a") + F.col("n_b")) * self.percent
        possible = (F.col("set_key_a") < F.col("set_key_b")) & (F.col("label_a") != F.col("label_b")) & self._possible() & enough
        first = F.get(common, F.lit(0)) == F.col("bucket")
        pairs = left.withColumnRenamed("bucket", "_bucket").join(right, (F.col("_bucket") == F.col("bucket")) & possible & first)
        return settle(pairs.select(F.col("set_key_a").alias("a"), F.col("set_key_b").alias("b"), "n_a", "n_b"))

    def _possible(self) -> Column:
        near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        return near & (similarity_of_bits("bits_a", "bits_b") >= lowest_estimate(self.percent))

    def _sets(self, members: DataFrame) -> DataFrame:
        """Full sets of the classes that share a bucket, from the text of one document each."""
        wanted = self.classes.join(members.select("set_key").distinct(), "set_key").select("set_key", "text_key")
        texts = self.docs.select("text_key", "text").join(wanted, "text_key").groupBy("set_key").agg(F.first("text").alias("text"))
        return settle(texts.mapInArrow(_shingler(self.size), "set_key decimal(38,0), shingles array<bigint>, bitmap array<bigint>"))

    def _hopeful(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sizes and bits leave a link possible, with their sizes."""
        signs = self.classes.select("set_key", "n", "bits")
        for side in "ab":
            pairs = pairs.join(signs.withColumnsRenamed({"set_key": side, "n": f"n_{side}", "bits": f"bits_{side}"}), side)
        return settle(pairs.filter(self._possible()).select("a", "b", "n_a", "n_b"))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        for side in "ba":
            pairs = pairs.join(self.sets.select(F.col("set_key").alias(side), F.col("shingles").alias(f"set_{side}")), side)
        common = F.size(F.array_intersect("set_a", "set_b"))
        return pairs.filter(common * 100 >= (F.col("n_a") + F.col("n_b") - common) * self.percent).select("a", "b")

    def rows(self) -> DataFrame:
        """``id, text_key, n_shingles, component, component_id``, one row per document."""
        label = self.labels().withColumnsRenamed({"node": "set_key", "label": "component"})
        ids = self.signed.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.min("id").alias("least"))
        placed = settle(ids.join(label, "set_key", "left").select("set_key", "least", F.coalesce("component", "set_key").alias("component")))
        least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
        classes = placed.select("set_key", "component").join(least, "component")
        own = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
        rows = self.signed.select("id", "text_key", "n_shingles", "set_key").join(classes, "set_key", "left")
        return rows.select("id", "text_key", "n_shingles", "component", own.alias("component_id"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups near-duplicates: ``<id>, n_shingles, component_id, kept``, one row per document.

    Two documents are linked when 100 * common >= percent * united distinct shingles; a component
    joins what links reach, and is named by its smallest id. A text of fewer words than a shingle is one
    shingle; a text that is null or has no words has none and is linked with nothing. Rows with
    a null id take part and name a component only if it has no other id; repeated rows are rows of
    their own, in one component. Very long texts are taken whole. ``kept`` marks rows that bear
    their component's id.
    """
    rows = NearDuplicates(docs, id_column, text_column, shingle, percent).rows()
    return rows.select(F.col("id").alias(id_column), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each group: the first by id, then by text hash; all input columns stay.

    Documents without words are kept, as they are linked with nothing. Of repeated rows one stays.
    """
    rows = NearDuplicates(docs, id_column, text_column, shingle, percent).rows()
    first = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "text_key")).alias("first"))
    wanted = {k: fresh(k) for k in ("id", "key")}
    chosen = first.select(F.col("first.id").alias(wanted["id"]), F.col("first.text_key").alias(wanted["key"])).distinct()
    wordless = rows.filter("component IS NULL").select(F.col("id").alias(wanted["id"]), F.col("text_key").alias(wanted["key"])).distinct()
    chosen = chosen.unionByName(wordless)
    mine = {"id": F.col(f"`{id_column}`").cast("bigint"), "key": text_key(text_of(text_column))}
    kept = docs.join(chosen, mine["id"].eqNullSafe(F.col(wanted["id"])) & (mine["key"] == F.col(wanted["key"])), "left_semi")
    if rows.groupBy("id", "text_key").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return kept
    names = {k: fresh(k) for k in mine}
    return put(kept, {names[k]: c for k, c in mine.items()}).dropDuplicates(list(names.values())).drop(*names.values())
