"""Helpers that several of the operators share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloft.session import pin_utc
from gaugeloft.storage import ship_package


#: Rows of a batch between Spark and a Python worker, for operators that take whole texts.
BATCH_ROWS = 500
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def workers(df: DataFrame) -> DataFrame:
    """Call before running Python in tasks: gives the workers this package."""
    ship_package(df.sparkSession)
    return df


def short_batches(df: DataFrame) -> DataFrame:
    """Call before running Python over texts: a batch, held in the JVM and in the worker at once, has few of them.

    It is a setting of the session, which stays; a smaller one is left as it is.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return df


def fresh(name: str) -> str:
    """A column name that no input has."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def put(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns. An input column of that name, in whatever case, is replaced."""
    taken = {c.lower() for c in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(name) for name, c in columns.items()])


def text_of(column: str) -> Column:
    """Text with null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
