"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells source x language x topic are raked until the weighted shares of sources,
languages and topics meet their targets. A cell's weight is a product of one factor per margin, so
sources, of which there may be any number, stay in a table with one row each, while languages and
topics are few by definition and their factors are small arrays. A document is sampled with a
probability in proportion to its cell's weight, the largest being 1; or, given a budget of tokens, with
probabilities that are cut at 1 and calibrated to the same targets again, as far as there are tokens for them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloft.llm.common import fresh, mixed, put, text_of, workers
from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

TOPIC_BITS = 3
TOPICS = 1 << TOPIC_BITS
LANGUAGES = ("de", "en", "es", "fr")
OTHER = "other"
ROUNDS = 60
INNER = 200
TOLERANCE = 1e-9
#: Calibrating under caps: rounds at most, and the error in shares that ends them.
CAPPED_ROUNDS, CAPPED_TOLERANCE = 400, 1e-4
PIECE = 1 << 18

_gap = re.compile(rb"[\x20\x09-\x0d]")
_draw = np.random.default_rng(0x70B1C)
LETTERS = _draw.integers(0, 1 << 63, 64 * 256, dtype=np.uint64)


def count_words(text: str | None) -> np.ndarray:
    """Words of a text by bin. A word, in lower case between ASCII white space, is hashed from its bytes and
    their places in it, all words of a piece of text at once; pieces end between words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    totals, start = np.zeros(TOPICS, dtype=np.int64), 0
    while start < len(data):
        gap = _gap.search(data, start + PIECE)
        end = gap.start() if gap else len(data)
        b = np.frombuffer(data[start:end], dtype=np.uint8)
        inside = (b != 32) & ((b < 9) | (b > 13))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        letters, first = b[inside], np.flatnonzero(begins[inside])
        if len(first):
            lengths = np.diff(first, append=len(letters))
            place = (np.arange(len(letters), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)) & 63
            hashes = mixed(np.add.reduceat(LETTERS.take((place << 8) | letters), first))
            totals += np.bincount((hashes >> np.uint64(64 - TOPIC_BITS)).astype(np.int64), minlength=TOPICS)
        start = end
    return totals


def word_bins(text: Column) -> Column:
    """How many words of a text fall into each of the topics' bins."""

    @F.pandas_udf("array<bigint>")
    def bins(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: count_words(t).tolist())

    return bins(text)


@dataclass(frozen=True)
class Margins:
    """What to aim at: shares by value, or a power of the observed shares (1 keeps them, 0 makes them even)."""

    source: float = 0.85
    language: dict[str, float] | float = 0.85
    topic: dict[str, float] | float = 0.85


@dataclass(frozen=True)
class Raked:
    """Factors per source (a table ``source, factor``), language and topic, the largest weight, and how far
    the language and topic shares are from their targets when the sources are met."""

    sources: DataFrame
    languages: np.ndarray
    topics: np.ndarray
    largest: float
    residual: float


def _target(aim: dict[str, float] | float, observed: np.ndarray, names: Sequence[str]) -> np.ndarray:
    """Target shares of a margin; what no document has gets none."""
    wanted = np.array([aim.get(n, 0.0) for n in names]) if isinstance(aim, dict) else np.power(observed, aim, where=observed > 0, out=np.zeros_like(observed))
    wanted = np.where(observed > 0, wanted, 0.0)
    return wanted / wanted.sum() if wanted.sum() else observed


def rake(cells: DataFrame, names: Sequence[str], margins: Margins, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Raked:
    """Rakes ``source, language (number), topic (number), tokens`` to the margins.

    In a round every source's factor follows from the others, and one sum over the sources gives the language
    x topic table, on which the two small margins are fitted. Only that table reaches the driver.
    """
    shape = (len(names), TOPICS)
    size = shape[0] * shape[1]
    at = F.col("language") * TOPICS + F.col("topic")
    sums = [F.coalesce(F.sum(F.when(at == i, F.col("tokens"))), F.lit(0)).cast("double") for i in range(size)]
    by_source = cells.groupBy("source").agg(F.array(*sums).alias("n"), F.sum("tokens").cast("double").alias("tokens"))
    by_source = settle(by_source.withColumn("aim", F.pow("tokens", F.lit(margins.source))))

    def table(factor: Column) -> np.ndarray:
        row = by_source.agg(*[F.sum(factor * F.get("n", F.lit(i))) for i in range(size)], F.sum("aim")).first()
        return np.array([x or 0.0 for x in row])

    first = table(F.lit(1.0))
    observed, aims = first[:size].reshape(shape), first[size] or 1.0
    total = observed.sum() or 1.0
    want_b = _target(margins.language, observed.sum(axis=1) / total, names)
    want_c = _target(margins.topic, observed.sum(axis=0) / total, [str(t) for t in range(TOPICS)])
    b, c = np.ones(shape[0]), np.ones(shape[1])

    def source_factor() -> Column:
        weights = [float(x) for x in np.outer(b, c).ravel()]
        weighted = F.aggregate(F.zip_with("n", F.array(*map(F.lit, weights)), lambda n, w: n * w), F.lit(0.0), lambda a, x: a + x)
        return F.when(weighted > 0, F.col("aim") / aims / weighted).otherwise(0.0)

    residual = 0.0
    for _ in range(rounds):
        held = table(source_factor())[:size].reshape(shape)
        shares = held * np.outer(b, c)
        residual = max(np.abs(shares.sum(axis=1) - want_b).max(), np.abs(shares.sum(axis=0) - want_c).max()) if shares.sum() else 0.0
        if residual <= tolerance:
            break
        for _ in range(INNER):
            before = b.copy(), c.copy()
            b = _fit(want_b, held @ c)
            c = _fit(want_c, b @ held)
            if np.allclose(b, before[0], rtol=1e-12) and np.allclose(c, before[1], rtol=1e-12):
                break
    factors = settle(by_source.select("source", "n", source_factor().alias("factor")))
    weights = [F.when(F.get("n", F.lit(i)) > 0, float(x)).otherwise(0.0) for i, x in enumerate(np.outer(b, c).ravel())]
    largest = factors.agg(F.max(F.col("factor") * F.greatest(*weights))).first()[0] or 1.0
    return Raked(factors.select("source", "factor"), b, c, largest, float(residual))


def within_supply(shares: np.ndarray, supply: np.ndarray, budget: float) -> np.ndarray:
    """Tokens to take of each value: ``budget`` by ``shares``, but no more than there are; what is short goes to the others in proportion."""
    out, open_ = np.zeros_like(supply, dtype=float), supply > 0
    while True:
        left = budget - out.sum()
        rest = np.where(open_, np.maximum(shares, 1e-12), 0.0)
        if left <= 1e-9 * budget or not open_.any():
            return out
        wish = left * rest / rest.sum()
        full = open_ & (wish >= supply)
        if not full.any():
            return out + wish
        out, open_ = np.where(full, supply, out), open_ & ~full


def cap(cells: DataFrame, names: Sequence[str], raked: Raked, budget: float) -> Raked:
    """Probabilities ``min(1, factor * factor * factor)`` that take a share ``budget`` of all tokens, in expectation.

    Starting from raked factors, every round brings each margin to its share of the budget, as capped cells leave
    it, the sources exactly. Sources, however few or many, stay in Spark: a round is one job over them, of which only
    the language x topic table reaches the driver. A margin value of which there are too few tokens is taken whole, and the others make up for it. The
    targets are the raked shares. ``residual`` is what the language and topic shares are still off by.
    """
    shape = (len(names), TOPICS)
    size = shape[0] * shape[1]
    at = F.col("language") * TOPICS + F.col("topic")
    sums = [F.coalesce(F.sum(F.when(at == i, F.col("tokens"))), F.lit(0)).cast("double") for i in range(size)]
    sources = cells.groupBy("source").agg(F.array(*sums).alias("n"), F.sum("tokens").cast("double").alias("tokens"))
    start = np.outer(raked.languages, raked.topics)
    weighted = F.aggregate(F.zip_with("n", F.array(*[F.lit(float(x)) for x in start.ravel()]), lambda n, w: n * w), F.lit(0.0), lambda a, x: a + x)
    sources = settle(join_small(sources, raked.sources, ["source"], "left").withColumn("raked", F.coalesce("factor", F.lit(0.0)) * weighted))
    totals = sources.agg(*[F.sum(F.get("n", F.lit(i))) for i in range(size)], *[F.sum(F.coalesce("factor", F.lit(0.0)) * F.get("n", F.lit(i))) for i in range(size)], F.sum("raked")).first()
    numbers = np.array([x or 0.0 for x in totals])
    supply, aims = numbers[:size].reshape(shape), numbers[size : 2 * size].reshape(shape) * start
    whole, goal = numbers[-1] or 1.0, budget * supply.sum()
    want_b, want_c = (within_supply(aims.sum(axis=k) / (aims.sum() or 1.0), supply.sum(axis=k), goal) for k in (1, 0))
    # Sources, of which there may be many, take turns at what others are short of by a common level.
    level = 1.0
    for _ in range(CAPPED_ROUNDS):
        short = F.col("raked") / whole * goal * level >= F.col("tokens")
        full, rest = sources.agg(F.coalesce(F.sum(F.when(short, F.col("tokens"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~short, F.col("raked"))), F.lit(0.0))).first()
        now = (goal - full) * whole / (rest * goal) if rest and goal else level
        if now <= level * (1 + 1e-12):
            break
        level = now
    wanted = F.least("tokens", F.col("raked") / whole * goal * level)
    b, c = raked.languages * (goal / whole), raked.topics.copy()
    goals = workers(sources).select("source", "n", wanted.alias("wanted"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in _numbers(batch, size)], ["n", "wanted"])

    # A round is a job of a few milliseconds over blocks of sources, without a plan of its own.
    blocks = settle(goals.mapInArrow(packed, "n binary, wanted binary")).rdd

    def held_now() -> np.ndarray:
        """Tokens taken per language and topic, once the sources' factors have followed the others."""
        w = np.outer(b, c).ravel()

        def taken(row: Row) -> np.ndarray:
            n = np.frombuffer(row["n"]).reshape(-1, size)
            return (n * np.minimum(1.0, source_factors(n, np.frombuffer(row["wanted"]), w)[:, None] * w)).sum(axis=0)

        return blocks.map(taken).treeAggregate(np.zeros(size), np.add, np.add).reshape(shape)

    residual = 0.0
    for _ in range(CAPPED_ROUNDS):
        held = held_now()
        residual = max(np.abs(held.sum(axis=1) - want_b).max(), np.abs(held.sum(axis=0) - want_c).max()) / (goal or 1.0)
        if residual <= CAPPED_TOLERANCE:
            break
        step_b = np.divide(want_b, held.sum(axis=1), out=np.ones(shape[0]), where=held.sum(axis=1) > 0)
        held = np.minimum(held * step_b[:, None], supply)
        b, c = b * step_b, c * np.divide(want_c, held.sum(axis=0), out=np.ones(shape[1]), where=held.sum(axis=0) > 0)
    last = np.outer(b, c).ravel()

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("source"), pa.array(source_factors(*_numbers(batch, size), last))], ["source", "factor"])

    found = goals.mapInArrow(fitted, T.StructType([sources.schema["source"], T.StructField("factor", T.DoubleType())]))
    return Raked(settle(found), b, c, 1.0, float(residual))


def source_factors(n: np.ndarray, wanted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The factor of each source (row) at which ``sum(n * min(1, factor * weights))`` is what is wanted, or all that can be had.

    With some cells taken whole and the others by weight the sum is a line in the factor, and the true sum is the least
    of these lines. Those that take the heaviest cells whole are enough, so the factor is the largest of their roots.
    """
    order = np.argsort(weights, kind="stable")
    order = order[weights[order] > 0]
    held = n[:, order]
    partly, slope = held.cumsum(axis=1), (held * weights[order]).cumsum(axis=1)
    left_out = np.maximum(held.sum(axis=1) - wanted, 0.0)
    roots = np.divide(partly - left_out[:, None], slope, out=np.zeros_like(slope), where=slope > 0)
    return roots.max(axis=1, initial=0.0)


def _numbers(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns ``n`` (rows of ``size`` numbers) and ``wanted`` of a batch."""
    n = batch.column("n").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return n, batch.column("wanted").to_numpy(zero_copy_only=False)


def _fit(wanted: np.ndarray, held: np.ndarray) -> np.ndarray:
    return np.divide(wanted, held, out=np.zeros_like(wanted), where=held > 0)


def mix(
    df: DataFrame,
    text_column: str = "text",
    source_column: str = "source",
    language_column: str = "lang",
    id_column: str = "doc_id",
    languages: Sequence[str] = LANGUAGES,
    margins: Margins = Margins(),
    seed: int = 0,
    budget: float | None = None,
) -> DataFrame:
    """Adds ``topic, n_tokens, weight, probability, kept``; input columns of these names are replaced.

    Tokens are words between white space plus one for the end. ``topic`` is the bin of words in which a text
    stands out most from all texts; ties, and texts without words, go to the first. Languages not named,
    and null, are one margin value ``other``; a null source is a source of its own. ``weight`` is the raked
    weight over the weight that an average token has, ``probability`` the weight over the largest,
    so the expected token shares are the raked ones. With a ``budget``, the share of all tokens to keep, probabilities
    are cut at 1 and calibrated again: a source, language or topic of too few tokens is kept whole, and the others get
    what it leaves, in proportion. So a rare cell does not make all others rarer. ``kept`` comes from a hash of seed, id and text: it
    depends on nothing else, and repeated rows share it. Empty and null texts are mixed by their margins,
    long ones are read whole; an empty table gives an empty one. Where margins contradict each other the
    weights of the last round stand.

    Texts are read twice and never shuffled, unless the table of sources is too large to broadcast;
    then rows are joined by source and hot sources are split at run time.
    """
    names = [*languages, OTHER]
    text = text_of(text_column)
    number = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col(f"`{language_column}`").cast("string")), F.lit(0))
    language = (F.when(number > 0, number).otherwise(len(names)) - 1).cast("int")
    counts = settle(workers(df).select(word_bins(text).alias("bins"), language.alias("language"), F.col(f"`{source_column}`").alias("source")))
    *every, rows = counts.agg(*[F.coalesce(F.sum(F.get("bins", F.lit(t))), F.lit(0)) for t in range(TOPICS)], F.count("*")).first()

    def topic(bins: Column) -> Column:
        excess = F.zip_with(bins, F.array(*[F.lit(1.0 / max(1, n)) for n in every]), lambda n, scale: n * scale)
        return (F.array_position(excess, F.array_max(excess)) - 1).cast("int")

    def tokens(bins: Column) -> Column:
        return F.aggregate(bins, F.lit(1).cast("bigint"), lambda a, n: a + n)

    known = counts.select("source", "language", topic(F.col("bins")).alias("topic"), tokens(F.col("bins")).alias("tokens"))
    cells = settle(known.groupBy("source", "language", "topic").agg(F.sum("tokens").alias("tokens")))
    raked = rake(cells, names, margins)
    sampled = raked if budget is None else cap(cells, names, raked, budget)
    t = {n: fresh(n) for n in ("bins", "language", "source", "factor", "rate", "u")}
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), text), 11) / float(1 << 53)
    binned = df.withColumns({t["bins"]: word_bins(text), t["language"]: language, t["source"]: F.col(f"`{source_column}`"), t["u"]: uniform})
    marked = put(binned, {"topic": topic(F.col(t["bins"])), "n_tokens": tokens(F.col(t["bins"]))})
    total = sum(every) + rows
    factors = raked.sources.withColumnsRenamed({"source": t["source"], "factor": t["factor"]})
    sampling = sampled.sources.withColumnsRenamed({"source": t["source"], "factor": t["rate"]})
    joined = join_small(marked, join_small(factors, sampling, [t["source"]]), [t["source"]], "left")

    def product(found: Raked, factor: str) -> Column:
        language_factor = F.get(F.array(*[F.lit(float(x)) for x in found.languages]), F.col(t["language"]))
        return F.col(factor) * language_factor * F.get(F.array(*[F.lit(float(x)) for x in found.topics]), F.col("topic"))

    weight = product(raked, t["factor"])
    probability = weight / raked.largest if budget is None else F.least(F.lit(1.0), product(sampled, t["rate"]))
    columns = {"weight": weight * float(total), "probability": probability, "kept": F.col(t["u"]) < probability}
    return put(joined, columns).drop(*t.values())
