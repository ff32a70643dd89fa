"""From raw documents to training shards: five stages, each written and read again.

Language identification drops documents of no known language; of each group of near-duplicates one stays;
documents that hold benchmark items go; the rest is sampled to the target mixture and dealt into shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.llm import decontamination, language, minhash, mixing, sharding
from gaugeloft.llm.common import fresh, table, text_of
from gaugeloft.session import fresh_dir

SHARDS, SEED = 64, 2025
#: The share of all tokens that mixing keeps.
BUDGET = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identify(docs).filter("accepted").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, shingle=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, seed=SEED, budget=BUDGET).filter("kept").select(docs.columns)


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``row_number, shard, slot``."""
    tie = fresh("text")
    marked = docs.withColumn(tie, F.xxhash64(text_of("text")))
    return sharding.shard_rows(marked, ["doc_id", tie], SHARDS, SEED).drop(tie)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_into_shards),
]

#: The stages hold a trained likelihood, alignments and an iteration, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
