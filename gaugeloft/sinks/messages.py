"""Message sinks, console output and fan-out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugeloft.functions.convert import to_message

# Fixed value: rows the console shows.
CONSOLE_ROWS = 10


def write_messages(df: DataFrame, topic: str, key: str = "vm_id", **options: str) -> None:
    """Rows as keyed JSON messages on a broker."""
    to_message(df, key).write.format("kafka").options(**options).option("topic", topic).save()


def stream_messages(df: DataFrame, topic: str, checkpoint: str, key: str = "vm_id", **options: str) -> StreamingQuery:
    """A stream's changed rows as keyed JSON messages on a broker."""
    writer = to_message(df, key).writeStream.format("kafka").options(**options).option("topic", topic)
    return writer.outputMode("update").option("checkpointLocation", checkpoint).start()


def console(df: DataFrame, rows: int = CONSOLE_ROWS) -> StreamingQuery:
    return df.writeStream.format("console").outputMode("update").option("truncate", "false").option("numRows", rows).start()


def show(df: DataFrame) -> None:
    df.show(truncate=False)


def fan_out(df: DataFrame, sinks: list[Callable[[DataFrame], None]]) -> None:
    """The same rows to several stores, computed once. A failing sink fails the batch, so it is retried."""
    if len(sinks) == 1:
        sinks[0](df)
        return
    held = df.persist()
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()
