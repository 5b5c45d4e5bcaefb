"""What became of every delivered event: kept, a duplicate, or late - as rows, not as counters.

``dropDuplicatesWithinWatermark`` removes re-deliveries and late rows without a trace. Here an arbitrary stateful operator
(``transformWithState``) gives every row back with its outcome. Keys are dealt into buckets by hash: state is one value per bucket, its
keys with the times until which they are remembered, and an event-time timer at the first of these times takes out what the watermark
has passed, so state empties behind the watermark as the built-in's does. A trigger reads and writes the buckets it has rows of, a
``buckets``-th of the remembered keys each.

The rules are those of the built-in operators: a row at or before the watermark is late, whatever its key; of the other rows of a
key the first one is kept and the rest are duplicates, until the watermark passes the kept row's time plus the delay. Within
a micro-batch the rows of a bucket are taken in order of time, then content, HELD_ROWS at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEPT, DUPLICATE, LATE = "kept", "duplicate", "late"
OUTCOME = "outcome"
#: Spark's state store for ``transformWithState``.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Groups of the stateful operator: a call of it has fixed costs that a group of one key would pay for every event.
BUCKETS = 256
#: Rows of a bucket that are put in order at a time.
HELD_ROWS = 100_000


def delay_ms(interval: str) -> int:
    """Milliseconds of an interval such as ``5 minutes``."""
    number, unit = interval.split()
    return int(number) * {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def outcome_processor(delay: int, columns: list[str]) -> StatefulProcessor:
    """The operator of one stream: per bucket of keys, the time until which each kept row's key is remembered. Defined in here, it
    travels to the workers with the query and needs no package there."""
    late, duplicate, kept, outcome, held = LATE, DUPLICATE, KEPT, OUTCOME, HELD_ROWS

    def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Frames joined up to ``held`` rows: one frame for a bucket, unless a trigger brings it more."""
        some, n = [], 0
        for frame in frames:
            some.append(frame)
            n += len(frame)
            if n >= held:
                yield pd.concat(some, ignore_index=True)
                some, n = [], 0
        if some:
            yield pd.concat(some, ignore_index=True)

    class Outcomes(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            fields = {"keys": T.ArrayType(T.StringType()), "ms": T.ArrayType(T.LongType()), "timer": T.LongType()}
            self.until = handle.getValueState("until", T.StructType([T.StructField(n, t) for n, t in fields.items()]))

        def _load(self) -> tuple[dict[str, int], int | None]:
            stored = self.until.get()
            return (dict(zip(stored[0], stored[1])), stored[2]) if stored else ({}, None)

        def _store(self, known: dict[str, int], timer: int | None) -> None:
            """One timer a bucket, at the first key to be forgotten."""
            if not known:
                self.until.clear()
                return
            first = min(known.values())
            if timer is None or first < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(first)
                timer = first
            self.until.update((list(known), list(known.values()), timer))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            watermark = timerValues.getCurrentWatermarkInMs()
            known, timer = self._load()
            before = len(known)
            for batch in gathered(rows):
                batch = batch.sort_values(["ms", "content"], kind="stable", ignore_index=True)
                told = []
                for delivered, ms in zip(batch["delivered"].tolist(), batch["ms"].tolist()):
                    if ms <= watermark:
                        told.append(late)
                    elif delivered in known:
                        told.append(duplicate)
                    else:
                        known[delivered] = ms + delay
                        told.append(kept)
                batch[outcome] = told
                yield batch[columns]
            if len(known) > before:
                self._store(known, timer)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            watermark = timerValues.getCurrentWatermarkInMs()
            self._store({k: ms for k, ms in self._load()[0].items() if ms > watermark}, None)
            return iter(())

        def close(self) -> None:
            pass

    return Outcomes()


def _key_text(events: DataFrame, key: str) -> F.Column:
    """A key as text, different for different keys; a missing one is a key as well."""
    nested = isinstance(events.schema[key].dataType, T.BinaryType | T.StructType | T.ArrayType)
    text = F.to_json(F.struct(F.col(key))) if nested else F.col(key).cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))


def delivery_outcomes(events: DataFrame, delay: str = "5 minutes", key: str = "event_key", time_col: str = "event_time", buckets: int = BUCKETS) -> DataFrame:
    """``events`` (a stream with an event time, without a watermark yet) with the column ``outcome``; one row out for each row in.

    The watermark runs on a copy of the event time that stays outside the stateful operator's input: an input column
    with a watermark would have its late rows dropped before the operator sees them. Needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    watched = events.withColumn("_clock", F.col(time_col)).withWatermark("_clock", delay)
    # plain names inside: the operator's frames do not take all names that a table may have
    names = [f"c{k}" for k in range(len(events.columns))]
    content = [c for c in events.columns if c not in (key, time_col)]
    keyed = watched.select(
        *[F.col(c).alias(n) for c, n in zip(events.columns, names, strict=True)],
        F.unix_millis(time_col).alias("ms"), F.xxhash64(*content).alias("content"), _key_text(events, key).alias("delivered"),
    ).withColumn("bucket", F.pmod(F.xxhash64("delivered"), F.lit(buckets)).cast("int"))
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, events.schema.fields, strict=True)]
    told = keyed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=outcome_processor(delay_ms(delay), [*names, OUTCOME]),
        outputStructType=T.StructType([*fields, T.StructField(OUTCOME, T.StringType())]), outputMode="Append", timeMode="EventTime",
    )
    return told.toDF(*events.columns, OUTCOME)
