"""Language of texts by Bayesian fusion of evidence.

    log p(language | all)  =  t * log p(text | language) + log p(declared | language)
                              + log p(suffix | language) + log p(language | host)

Text likelihoods come from hashed letter trigrams, counted per declared language over all documents. How far
the declared language and the suffix of the address can be trusted is counted against what the text alone
says. Host priors are smoothed in steps: the host towards its domain, the domain towards its
suffix, the suffix towards all documents. All counts are grouped aggregations.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloft.llm.common import fresh, put, short_batches, text_of, workers
from gaugeloft.operators.joins import join_small
from gaugeloft.session import settle

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
BUCKETS = 1 << 14
TEMPER = 0.2
PRIOR_UNKNOWN = 1e-3
STRENGTH = 8.0
LEAST = 0.5
PIECE = 1 << 20

#: Bytes outside letters become blanks; bytes of other scripts and accents stay.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's letter trigrams (bytes of UTF-8, blanks squeezed), piece by piece."""
    data = b" " + b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "
    for start in range(0, len(data) - 2, PIECE):
        b = np.frombuffer(data[start : start + PIECE + 2], dtype=np.uint8).astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        yield ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def trigram_counts(df: DataFrame, text: Column, declared: Column, languages: Sequence[str]) -> np.ndarray:
    """Trigram counts per language over all rows with that declared language.

    A task sends one row per language and bucket it met; the driver gets languages x BUCKETS numbers at most.
    """
    numbers = {language: i for i, language in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(numbers), BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, language in zip(batch.column("text"), batch.column("declared"), strict=True):
                row = numbers.get(language.as_py())
                if row is not None:
                    for buckets in trigram_buckets(text.as_py()):
                        totals[row] += np.bincount(buckets, minlength=BUCKETS)
        rows, buckets = np.nonzero(totals)
        columns = [pa.array(rows, pa.int32()), pa.array(buckets, pa.int32()), pa.array(totals[rows, buckets], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "bucket", "n"])

    counted = df.select(text.alias("text"), declared.alias("declared")).mapInArrow(count, "row int, bucket int, n bigint")
    out = np.zeros((len(numbers), BUCKETS))
    for row, bucket, n in counted.groupBy("row", "bucket").agg(F.sum("n")).collect():
        out[row, bucket] = n
    return out


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """Per language, and last for unknown text, the log probability of each bucket; smoothed by one half.

    Unknown text is taken as even over all buckets. A language without a document is as likely as that.
    """
    smooth = counts + 0.5
    known = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return np.vstack([known, np.full((1, counts.shape[1]), -np.log(counts.shape[1]))]).astype(np.float32)


def scored(text: Column, table: np.ndarray) -> Column:
    """Tempered log likelihood of a text per language, last the unknown; zeros without letters."""

    def one(text: str | None) -> list[float]:
        total = np.zeros(len(table))
        for buckets in trigram_buckets(text):
            total += table[:, buckets].sum(axis=1, dtype=np.float64)
        return (total * TEMPER).tolist()

    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return score(text)


def host_of(address: Column) -> Column:
    """Host of an address in lower case; an address without a scheme is a host itself. Null is empty."""
    plain = F.lower(F.coalesce(address.cast("string"), F.lit("")))
    return F.regexp_extract(plain, r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#]*)", 1)


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    """What follows the last dot; empty without one."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise("")


class Evidence:
    """What all documents together say about languages, hosts, declarations and suffixes."""

    def __init__(self, df: DataFrame, text: Column, declared: Column, address: Column, languages: Sequence[str]):
        self.names = [*languages, UNKNOWN]
        self.table = log_likelihoods(trigram_counts(short_batches(workers(df)), text, declared, languages))
        host = host_of(address)
        scores = scored(text, self.table)
        judged = df.select(host.alias("host"), declared.alias("declared"), scores.alias("scores"))
        best = F.array_position("scores", F.array_max("scores")).cast("int") - 1
        counted = judged.withColumn("best", best).groupBy("host", "declared", "best").agg(F.count("*").alias("n"))
        self.counts = settle(counted.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}))

    def _per(self, keys: list[str]) -> DataFrame:
        """Documents per key and language, as arrays."""
        sums = [F.coalesce(F.sum(F.when(F.col("best") == i, F.col("n"))), F.lit(0)).cast("double") for i in range(len(self.names))]
        return self.counts.groupBy(*keys).agg(F.array(*sums).alias("n"))

    def priors(self) -> DataFrame:
        """``host, prior``: languages of a host, each level counting STRENGTH documents of the level above."""
        whole = self._per([]).first()["n"]
        total = sum(whole)
        top = [(n + 1) / (total + len(whole)) for n in whole]
        top[-1] = min(top[-1], PRIOR_UNKNOWN)

        def smooth(n: Column, above: Column) -> Column:
            size = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
            return F.zip_with(n, above, lambda x, p: (x + STRENGTH * p) / (size + STRENGTH))

        suffixes = self._per(["suffix"]).select("suffix", smooth(F.col("n"), F.array(*map(F.lit, top))).alias("above"))
        domains = join_small(self._per(["suffix", "domain"]), suffixes, ["suffix"]).select("domain", smooth(F.col("n"), F.col("above")).alias("above"))
        hosts = join_small(self._per(["domain", "host"]), domains, ["domain"])
        return settle(hosts.select("host", smooth(F.col("n"), F.col("above")).alias("prior")))

    def trust(self, column: str, values: Sequence[str]) -> dict[str, list[float]]:
        """log p(value | language) for the given values; others and none are told apart from them only.

        The values are the languages themselves, so this has languages x languages numbers.
        """
        shown = F.when(F.col(column).isin(*values), F.col(column)).otherwise("")
        counts = {r["shown"]: r["n"] for r in self._per_shown(shown).collect()}
        rows = np.array([counts.get(v, [0.0] * len(self.names)) for v in [*values, ""]]) + 1.0
        return dict(zip([*values, ""], np.log(rows / rows.sum(axis=0)).tolist(), strict=True))

    def _per_shown(self, shown: Column) -> DataFrame:
        sums = [F.coalesce(F.sum(F.when(F.col("best") == i, F.col("n"))), F.lit(0)).cast("double") for i in range(len(self.names))]
        return self.counts.groupBy(shown.alias("shown")).agg(F.array(*sums).alias("n"))


def identify(
    df: DataFrame, text_column: str = "text", declared_column: str = "lang", address_column: str = "source", languages: Sequence[str] = LANGUAGES, least: float = LEAST
) -> DataFrame:
    """Adds ``language``, ``confidence`` and ``accepted``; input columns of these names are replaced.

    ``language`` is the most probable of ``languages`` or ``und``, ``confidence`` its probability. A document is
    accepted if it has letters, is of a known language and its confidence reaches ``least``. A null or empty
    text, or one without letters, is ``und`` with confidence 0 and not accepted. A null or foreign declaration
    counts as no declaration, a null address as the empty host. Equal probabilities go to the language
    first in the list. Long texts are read whole, in pieces. Documents are judged one by one, so
    repeated rows give repeated results; an empty table gives an empty one.

    Texts are read three times and never shuffled, unless the table of hosts is too large to broadcast:
    then rows are joined by host, and hot hosts are split at run time.
    """
    text = text_of(text_column)
    declared = F.lower(F.substring_index(F.substring_index(F.trim(text_of(declared_column)), "-", 1), "_", 1))
    evidence = Evidence(df, text, declared, F.col(f"`{address_column}`"), languages)
    said, ended = evidence.trust("declared", languages), evidence.trust("suffix", languages)
    names = {n: fresh(n) for n in ("host", "scores", "total", "best", "odds")}
    placed = put(workers(df), {names["host"]: host_of(F.col(f"`{address_column}`"))})
    placed = join_small(placed, evidence.priors().withColumnsRenamed({"host": names["host"], "prior": names["odds"]}), [names["host"]], "left")

    def told(value: Column, table: dict[str, list[float]]) -> Column:
        out = F.array(*map(F.lit, table[""]))
        for key, row in table.items():
            if key:
                out = F.when(value == key, F.array(*map(F.lit, row))).otherwise(out)
        return out

    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    prior = F.transform(names["odds"], lambda p: F.log(p))
    marked = placed.withColumn(names["scores"], scored(text, evidence.table))
    fused = add(add(F.col(names["scores"]), prior), add(told(declared, said), told(suffix_of(F.col(names["host"])), ended)))
    marked = marked.withColumn(names["total"], fused)
    total = F.col(names["total"])
    top = F.array_max(total)
    share = 1 / F.aggregate(total, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    lettered = F.exists(names["scores"], lambda x: x < 0)
    best = F.element_at(F.array(*map(F.lit, evidence.names)), F.array_position(total, top).cast("int"))
    language = F.when(lettered, best).otherwise(UNKNOWN)
    confidence = F.when(lettered, share).otherwise(0.0)
    accepted = lettered & (best != UNKNOWN) & (share >= least)
    return put(marked, {"language": language, "confidence": confidence, "accepted": accepted}).drop(*names.values())
