"""Streaming sinks: durable Parquet append, console monitoring in update mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _with_trigger(writer, trigger_seconds: int | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger_seconds:
        return writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer


def parquet_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int | None = 30,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append-mode Parquet sink: each window is written once, when the watermark closes it.

    The sink's ``_spark_metadata`` log plus the checkpoint make it exactly-once across restarts;
    read it back with Spark (which honours that log), not with a plain file lister.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger_seconds, available_now).start()


def console_update(
    df: DataFrame,
    checkpoint: str,
    num_rows: int = 10,
    trigger_seconds: int | None = 30,
    available_now: bool = False,
) -> StreamingQuery:
    """Update-mode console sink: windows changed in each trigger, for watching a live job."""
    writer = (
        df.writeStream.format("console")
        .outputMode("update")
        .option("truncate", "false")
        .option("numRows", str(num_rows))
        .option("checkpointLocation", checkpoint)
    )
    return _with_trigger(writer, trigger_seconds, available_now).start()
