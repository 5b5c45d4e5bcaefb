"""Edit events from a message bus (Kafka) or from files standing in for it.

The Kafka connector jar is a deployment dependency (``--packages``); these builders only assemble
the documented ``kafka.*`` / source options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from navstream.settings import KafkaSettings

RECORD_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType(), True), T.StructField("value", T.StringType(), True)]
)


def kafka_source_options(settings: KafkaSettings = KafkaSettings()) -> dict[str, str]:
    """Subscribe to the edit topic; cap intake per trigger; survive purged offsets."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }


def read_topic_stream(spark: SparkSession, settings: KafkaSettings = KafkaSettings()) -> DataFrame:
    """Streaming ``key, value`` (binary) records of the edit topic."""
    return spark.readStream.format("kafka").options(**kafka_source_options(settings)).load().select("key", "value")


def read_topic_batch(
    spark: SparkSession,
    settings: KafkaSettings = KafkaSettings(),
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
) -> DataFrame:
    """Batch read of a bounded offset range (backfill / replay). A range that is partly gone is an error: only the
    live stream may skip purged offsets."""
    options = kafka_source_options(settings)
    options.pop("maxOffsetsPerTrigger")
    options.update(startingOffsets=starting_offsets, endingOffsets=ending_offsets, failOnDataLoss="true")
    return spark.read.format("kafka").options(**options).load().select("key", "value")


def read_record_files_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming ``key, value`` records from files landing in ``path`` (same contract as the topic)."""
    reader = spark.readStream.schema(RECORD_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
