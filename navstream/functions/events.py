"""Scalar helpers for edit events: message key, ingestion stamp, event time, size delta, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navstream.settings import EVENT_SECONDS, LABEL_SEPARATOR


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _blank_if_null(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def message_key(
    wiki: Column | str = "wiki",
    rev_new: Column | str = "revision.new",
    timestamp: Column | str = "timestamp",
    title: Column | str = "title",
) -> Column:
    """Deterministic event identity: ``wiki:rev_new``, else ``wiki:timestamp:title``.

    The revision form needs a non-zero revision and a non-empty wiki. Missing and NULL fields
    both render as '' (never as a literal "None").
    """
    wiki, rev_new, timestamp, title = _c(wiki), _c(rev_new), _c(timestamp), _c(title)
    has_revision = F.coalesce(
        rev_new.isNotNull() & (rev_new != 0) & wiki.isNotNull() & (wiki != ""), F.lit(False)
    )
    return F.when(has_revision, F.concat_ws(":", wiki, rev_new.cast("string"))).otherwise(
        F.concat_ws(":", _blank_if_null(wiki), _blank_if_null(timestamp), _blank_if_null(title))
    )


def ingested_at() -> Column:
    """UTC ISO-8601 stamp (``2024-01-01T00:00:00.000000+00:00``) of when a record enters the pipeline."""
    utc_wall_clock = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(utc_wall_clock, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def event_time_from_epoch(col: Column | str = "timestamp") -> Column:
    """Epoch seconds -> TIMESTAMP; NULL and seconds outside EVENT_SECONDS give NULL."""
    seconds = _c(col)
    return F.when(seconds.between(*EVENT_SECONDS), F.timestamp_seconds(seconds))


def size_delta(new: Column | str = "length.new", old: Column | str = "length.old") -> Column:
    """Byte delta of an edit, in 64 bits so int extremes cannot overflow; NULL if a side is missing."""
    return _c(new).cast("bigint") - _c(old).cast("bigint")


def pair_label(prev: Column | str = "prev", curr: Column | str = "curr", sep: str = LABEL_SEPARATOR) -> Column:
    """Display label ``prev  →  curr``; NULL if either side is NULL."""
    return F.concat(_c(prev), F.lit(sep), _c(curr))
