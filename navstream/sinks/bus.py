"""Publishing keyed JSON edit events to the bus (Kafka)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from navstream.functions.events import ingested_at, message_key
from navstream.settings import KafkaSettings


def enrich(df: DataFrame) -> DataFrame:
    """Stamps ``_ingested_at`` (UTC ISO-8601) on each event."""
    return df.withColumn("_ingested_at", ingested_at())


def _field(events: DataFrame, name: str) -> F.Column:
    top = name.split(".")[0]
    return F.col(name) if top in events.columns else F.lit(None)


def to_bus_records(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``key, value``: the event identity and the event as JSON (NULL fields omitted).

    Payload fields the key needs but the frame lacks count as missing ('' in the key). ``carry`` columns stay
    beside the record and out of its JSON.
    """
    key = message_key(
        _field(events, "wiki"), _field(events, "revision.new"), _field(events, "timestamp"), _field(events, "title")
    )
    fields = [c for c in events.columns if c not in carry]
    return events.select(*carry, key.alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def publishable(events: DataFrame, wiki: str | None = None) -> DataFrame:
    """Producer side in one step: keep one wiki (None keeps all), stamp, key and serialise."""
    kept = events if wiki is None else events.filter(F.col("wiki") == wiki)
    return to_bus_records(enrich(kept))


def kafka_sink_options(settings: KafkaSettings = KafkaSettings()) -> dict[str, str]:
    """Topic plus producer tuning, passed through as ``kafka.``-prefixed options."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "topic": settings.topic,
        "kafka.acks": str(settings.producer_acks),
        "kafka.compression.type": settings.producer_compression,
        "kafka.linger.ms": str(settings.producer_linger_ms),
        "kafka.batch.size": str(settings.producer_batch_size),
        "kafka.buffer.memory": str(settings.producer_buffer_memory),
        "kafka.retries": str(settings.producer_retries),
    }


def publish(records: DataFrame, settings: KafkaSettings = KafkaSettings()) -> None:
    """Batch publish of ``key, value`` records."""
    records.write.format("kafka").options(**kafka_sink_options(settings)).save()


def publish_stream(records: DataFrame, checkpoint: str, settings: KafkaSettings = KafkaSettings()) -> StreamingQuery:
    """Continuous publish of a streaming ``key, value`` frame."""
    return (
        records.writeStream.format("kafka")
        .options(**kafka_sink_options(settings))
        .option("checkpointLocation", checkpoint)
        .start()
    )
