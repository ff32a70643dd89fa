"""All registered queries: name to (query, SQL twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeloft.plans import point_queries, quality_queries, reading_queries, stream_queries

REGISTRY = {**reading_queries.QUERIES, **point_queries.QUERIES, **quality_queries.QUERIES, **stream_queries.QUERIES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_queries.gold_from_topic(spark, sf_dir)
