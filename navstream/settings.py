"""Tunables as frozen dataclasses.

Defaults reproduce the values the original application hard-wired as module globals; every job and
operator takes them as arguments instead, so nothing reads global state.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must match the original application for identical results.
VALID_LINK_TYPES = ("link", "external", "other")
MONTH_PATTERN = r"^\d{4}-\d{2}$"
MONTH_FROM_PATH_PATTERN = r"(\d{4}-\d{2})\.tsv\.gz$"
EXCLUDED_ARTICLES = ("Main_Page", "Hyphen-minus")
LABEL_SEPARATOR = "  →  "
REASON_SEPARATOR = "|"
# Epoch seconds an edit may carry (1970 to 2100): beyond it lie millisecond stamps and overflows, which would
# move the watermark by millennia or stop the query.
EVENT_SECONDS = (0, 4_102_444_800)
# Contract rule codes, in the order they appear in a quarantine reason string.
REASON_CODES = ("null_prev", "null_curr", "bad_type", "neg_n", "bad_month")


@dataclass(frozen=True)
class BatchSettings:
    """Clickstream batch layer."""

    raw_glob: str = "data/raw/clickstream-enwiki-*.tsv.gz"
    output_dir: str = "data/batch_output"
    quarantine_dir: str = "data/quarantine/clickstream"
    top_n: int = 50
    months: tuple[str, ...] = ("2024-10", "2024-11", "2024-12", "2025-01", "2025-02", "2025-03")
    month_from_path_pattern: str = MONTH_FROM_PATH_PATTERN
    # None keeps one scan task per input file; set it to spread unsplittable .gz inputs.
    scan_partitions: int | None = None


@dataclass(frozen=True)
class KafkaSettings:
    """Edit-event topic and the producer/consumer knobs of the streaming layer."""

    bootstrap_servers: str = "localhost:9092"
    topic: str = "wiki-edits"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 10_000
    fail_on_data_loss: bool = False
    producer_acks: str = "1"
    producer_compression: str = "lz4"
    producer_linger_ms: int = 10
    producer_batch_size: int = 128 * 1024
    producer_buffer_memory: int = 64 * 1024 * 1024
    producer_retries: int = 5


@dataclass(frozen=True)
class StreamSettings:
    """Structured Streaming layer."""

    watermark: str = "5 minutes"
    rate_window: str = "1 minute"
    editor_window: str = "5 minutes"
    editor_slide: str = "1 minute"
    type_window: str = "1 minute"
    trigger_seconds: int = 30
    output_dir: str = "data/streaming_output"
    checkpoint_dir: str = "data/streaming_checkpoint"
    # One wiki for the whole layer (the same meaning as ``publishable(wiki=...)``); None keeps all.
    wiki_filter: str | None = None
    console_rows: int = 10
    # Keep dedup/window state in RocksDB (off-heap, spills to local disk) instead of the JVM heap.
    rocksdb_state: bool = True
    kafka: KafkaSettings = field(default_factory=KafkaSettings)


@dataclass(frozen=True)
class ServingSettings:
    """Dashboard queries over the marts."""

    top_k: int = 20
    trend_top_k: int = 10
    editors_top_k: int = 15
    rate_wiki: str = "enwiki"
    excluded_articles: tuple[str, ...] = EXCLUDED_ARTICLES
