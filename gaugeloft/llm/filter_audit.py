"""How filters interact: what each removes, in every order, from sorted posting lists of failing rows.

Rows get numbers. Of each part (say a language) and each range of row numbers the failing rows of every
filter are kept as a sorted list, and so are the labelled rows. A task joins the lists of its cell by galloping
merges: the shorter list is looked up in the longer one. What it returns are sizes of unions, whole and
within each label, one row per set of filters; these add up over the ranges, and every count of every
order is a difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gaugeloft.llm.common import text_of, workers
from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

FILTERS = "ABCDE"
RANGE = 1 << 16
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: Bytes that go on with a character, so that what is left counts code points.
FOLLOWING = bytes(range(0x80, 0xC0))
TRAITS = "row bigint, doc_id bigint, part string, first_hash bigint, second_hash bigint, few_words boolean, repetitive boolean, shouting boolean, marked boolean"
SIZES = "part string, filters int, n bigint, good bigint, toxic bigint"


def traits(text: str | None) -> tuple[bool, bool, bool, bool]:
    """Which of the four filters that look at one text turn it away."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    points = len(data.translate(None, FOLLOWING))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * points,
        len(data.translate(None, MARKS)) < len(data),
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, found = [], []
        for text in batch.column("text"):
            value = text.as_py()
            found.append(traits(value))
            hashes.append(xxhash.xxh3_128_digest((value or "").encode("utf-8", "surrogatepass")))
        pair = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
        flags = np.array(found, dtype=bool).reshape(-1, 4)
        columns = [batch.column("row"), batch.column("doc_id"), batch.column("part"), *(pa.array(pair[:, i], pa.int64()) for i in range(2)), *(pa.array(flags[:, i]) for i in range(4))]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in TRAITS.split(", ")])


def failing(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """The five filters per row: ``row, doc_id, part, A, B, C, D, E``; row numbers are fixed in a table.

    A: under 200 words; B: fewer than half of the words are distinct; C: more than 3% of the code points are
    A-Z; D: holds one of ``#$%&*|``; E: a smaller id has the same text, anywhere in the table. Words
    lie between ASCII white space and keep their case. A null text is empty, a null part is the empty
    string. A null id neither makes others fail E nor fails it; rows repeated under one id don't
    make each other fail. Equal texts are found by a hash of 128 bits; the least id of each is combined before the
    shuffle, and a text that very many rows have is joined back by broadcast or, if too many texts repeat,
    by a join whose hot keys are split.
    """
    rows = workers(docs).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        text_of(part_column).alias("part"),
        text_of(text_column).alias("text"),
    )
    seen = settle(rows.mapInArrow(_judge, TRAITS))
    hashes = ["first_hash", "second_hash"]
    repeated = seen.groupBy(*hashes).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").drop("most")
    joined = join_small(seen, settle(repeated), hashes, "left")
    again = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return joined.select("row", "doc_id", "part", F.col("few_words").alias("A"), F.col("repetitive").alias("B"), F.col("shouting").alias("C"), F.col("marked").alias("D"), again.alias("E"))


def gallop(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which members of the sorted ``a`` the sorted ``b`` holds, by looking the shorter list up in the longer one."""
    inside = np.zeros(len(a), dtype=bool)
    if not len(a) or not len(b):
        return inside
    low, high = np.searchsorted(b, a[0]), np.searchsorted(b, a[-1], side="right")
    b = b[low:high]
    if not len(b):
        return inside
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        at[at == len(b)] = len(b) - 1
        return b[at] == a
    at = np.searchsorted(a, b)
    inside[at[a[at] == b]] = True
    return inside


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both sorted lists as one, each member once: what the shorter one adds is put into its places."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    added = b[~gallop(b, a)]
    return np.insert(a, np.searchsorted(a, added), added) if len(added) else a


def union_sizes(lists: Sequence[np.ndarray], within: Sequence[np.ndarray]) -> np.ndarray:
    """For each set of filters, as bits: the size of the union of their lists, and of its cut with each of ``within``."""
    unions = [np.zeros(0, dtype=np.int64)]
    out = np.zeros((1 << len(lists), 1 + len(within)), dtype=np.int64)
    for subset in range(1, 1 << len(lists)):
        top = subset.bit_length() - 1
        unions.append(union(unions[subset ^ 1 << top], lists[top]))
        out[subset] = [len(unions[subset]), *(int(gallop(w, unions[subset]).sum()) for w in within)]
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*FILTERS, "good", "toxic"]
    for batch in batches:
        parts: list[str | None] = []
        found = []
        for i in range(batch.num_rows):
            lists = [batch.column(n)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for n in names]
            found.append(union_sizes(lists[:-2], lists[-2:]))
            found[-1][0] = [batch.column("n")[i].as_py(), len(lists[-2]), len(lists[-1])]
            parts += [batch.column("part")[i].as_py()] * len(found[-1])
        if not found:
            continue
        sizes = np.vstack(found)
        filters = np.tile(np.arange(1 << len(FILTERS), dtype=np.int32), len(found))
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(filters), *(pa.array(sizes[:, j]) for j in range(3))], [c.split()[0] for c in SIZES.split(", ")])


def posting_lists(rows: DataFrame) -> DataFrame:
    """Cells ``part, range, n`` with a sorted list of rows for each filter, for ``good`` and for ``toxic``.

    A range has 65,536 row numbers, so no list is longer, however large its part.
    """
    listed = [F.sort_array(F.collect_list(F.when(F.col(c), F.col("row")))).alias(c) for c in [*FILTERS, "good", "toxic"]]
    cell = F.shiftright("row", int(RANGE).bit_length() - 1).alias("range")
    return rows.groupBy("part", cell).agg(F.count("*").alias("n"), *listed)


def subset_sizes(rows: DataFrame) -> DataFrame:
    """``part, filters, n, good, toxic``: for each part and set of filters (bit i is the i-th) how many rows fail
    any of them, and how many of those are labelled. Set 0 has all rows of the part instead."""
    sizes = posting_lists(rows).mapInArrow(_merge, SIZES)
    return sizes.groupBy("part", "filters").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang", quality_column: str = "quality", toxic_column: str = "toxic"
) -> DataFrame:
    """Counts per part, order of the filters and step: ``part, filter_order, step, filter, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    One row for each of the 120 orders and 5 steps, zeros included, for every part that has rows. ``kept`` are
    left after the step and ``removed`` go in it; ``redundant`` fail its filter but went earlier; ``unique_fails``
    fail no other filter; ``good_lost`` and ``toxic_lost`` are those removed that are labelled so; ``shapley``
    is what the filter removes, summed over all orders. The filters and their cases are those of
    ``failing``. An id counts as good (toxic) if any of its labels says 1; null ids have no label, repeated rows
    count each. An empty table gives no rows.
    """
    known = labels.groupBy(F.col(f"`{id_column}`").cast("bigint").alias("doc_id")).agg(
        F.coalesce(F.max(F.col(f"`{quality_column}`") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col(f"`{toxic_column}`") == 1), F.lit(False)).alias("toxic")
    )
    rows = join_small(failing(docs, id_column, text_column, part_column), settle(known.filter("doc_id IS NOT NULL AND (good OR toxic)")), ["doc_id"], "left")
    sizes = subset_sizes(rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}))
    return by_order(sizes)


def by_order(sizes: DataFrame) -> DataFrame:
    """All orders and steps from the sizes of unions; a part has 32 of these."""
    subsets = 1 << len(FILTERS)
    listed = F.sort_array(F.collect_list(F.struct("filters", "n", "good", "toxic"))).alias("u")
    orders = ["".join(p) for p in permutations(FILTERS)]
    at = F.explode(F.sequence(F.lit(0), F.lit(len(orders) * len(FILTERS) - 1))).alias("at")
    steps = sizes.groupBy("part").agg(listed).select("part", "u", at)
    order = F.get(F.array(*map(F.lit, orders)), F.floor(F.col("at") / len(FILTERS)).cast("int"))
    placed = steps.select("part", "u", order.alias("filter_order"), (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"))
    values = F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])
    bits = F.transform(F.split("filter_order", ""), lambda c: F.get(values, F.ascii(c) - ord(FILTERS[0])))

    def upto(n: Column) -> Column:
        return F.aggregate(F.slice(bits, 1, n), F.lit(0), lambda a, x: a + x)

    placed = placed.select("*", F.substr("filter_order", "step", F.lit(1)).alias("filter"), upto(F.col("step") - 1).alias("before"), upto(F.col("step")).alias("after"))

    def size(subset: Column, of: str = "n") -> Column:
        """Rows in the union; none for the empty set, whose entry has all rows of the part."""
        return F.when(subset == 0, F.lit(0)).otherwise(F.get("u", subset)[of])

    own, all_others = F.col("after") - F.col("before"), F.lit(subsets - 1) - F.col("after") + F.col("before")
    removed = size(F.col("after")) - size(F.col("before"))
    counted = placed.select(
        "part", "filter_order", "step", "filter",
        (F.get("u", F.lit(0))["n"] - size(F.col("after"))).alias("kept"),
        removed.alias("removed"),
        (size(own) - removed).alias("redundant"),
        (size(F.lit(subsets - 1)) - size(all_others)).alias("unique_fails"),
        *[(size(F.col("after"), c) - size(F.col("before"), c)).alias(f"{c}_lost") for c in ("good", "toxic")],
    )
    return counted.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "filter")))
