"""The registered queries of this package: name to (query, SQL twin or None)."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.llm import decontamination, filter_audit, html_text, language, lexical_search, licenses, minhash, mixing, packing, pii, sharding, token_files, topk
from gaugeloft.llm.common import table, text_of
from gaugeloft.llm.sql import AUDIT_SQL, DUPLICATES_SQL, PII_SQL, SEARCH_SQL, SHARD_SEED, SHARDS, SHARDS_SQL, TOPK_SQL
from gaugeloft.session import fresh_dir


TOKENIZER, END_ID = "word_bpe_49k.json", 1
PACKED_TOKENIZER, PACKED_END_ID = "byte_bpe_50k.json", 2
MIX_BUDGET = 0.5


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of("text")
    sizes = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.shard_rows(sizes, ["doc_id", "text_crc32", "size"], SHARDS, SHARD_SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "language", F.round("confidence", 6).alias("confidence"), F.col("accepted").alias("kept"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.find_personal_data(docs), "doc_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), budget=MIX_BUDGET)
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 9).alias("weight"), F.round("probability", 9).alias("probability"), "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_dir(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_token_files(spark, path)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKED_TOKENIZER), PACKED_END_ID, capacity=1024).drop("ids")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_sharding": (op1_sharding, SHARDS_SQL),
    "op2_exact_topk": (op2_exact_topk, TOPK_SQL),
    "op3_minhash": (op3_minhash, DUPLICATES_SQL),
    "op4_language": (op4_language, None),
    "op5_main_text": (op5_main_text, None),
    "op6_personal_data": (op6_personal_data, PII_SQL),
    "op7_mixing": (op7_mixing, None),
    "op9_decontamination": (op9_decontamination, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op8_token_files": (op8_token_files, None),
    "op10_licences": (op10_licences, None),
    "op11_filter_audit": (op11_filter_audit, AUDIT_SQL),
    "op12_packing": (op12_packing, None),
    "op13_lexical_search": (op13_lexical_search, SEARCH_SQL),
}
