"""Hook that hands rows to a scorer as JSON, inside the tasks that hold them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gaugeloft.storage import ship_package

PAYLOAD = "_payload"


def score(df: DataFrame, scorer: Callable[[list[str]], list[float]], name: str = "score") -> DataFrame:
    """Adds the scorer's number to each row. The scorer gets the JSON texts of one batch at a time."""
    ship_package(df.sparkSession)
    schema = StructType([*df.schema.fields, StructField(name, DoubleType(), True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = scorer(batch[PAYLOAD].tolist())
            yield batch.drop(columns=PAYLOAD).assign(**{name: scores})

    return df.withColumn(PAYLOAD, F.to_json(F.struct(*df.columns))).mapInPandas(run, schema)
