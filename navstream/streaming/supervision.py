"""Watching and restarting streams: progress as a table, restarts with limits.

``ProgressLog`` is a listener that writes one small JSON file for every finished batch (rows read, rows dropped as late, rows held in state,
lag of the watermark behind the clock) below a shared folder; ``read_progress`` is the table of them. ``supervise`` runs a query and starts
it again from its checkpoint when it fails, until a limit of failures within a time is reached; offsets, state and the sink's ledger make the
restarted query go on without loss or repeats.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "query string, run string, batch long, at timestamp, input_rows long, late_rows long, state_rows long, watermark timestamp, lag_seconds double"
)


@dataclass(frozen=True)
class RestartPolicy:
    """At most ``failures`` failures within ``seconds``; ``pause`` seconds before a restart, doubled each time."""

    failures: int = 3
    seconds: float = 3600.0
    pause: float = 1.0


class TooManyFailures(RuntimeError):
    """The restart policy is used up; the last failure is its cause."""


def _seconds(stamp: str | None) -> float | None:
    return datetime.fromisoformat(stamp.replace("Z", "+00:00")).timestamp() if stamp else None


def progress_row(progress: dict) -> dict:
    """What one progress report comes to."""
    states = progress.get("stateOperators") or []
    watermark, at = _seconds((progress.get("eventTime") or {}).get("watermark")), _seconds(progress["timestamp"])
    known = watermark if watermark and watermark > 0 else None
    return {
        "query": progress.get("name") or progress["id"], "run": progress["runId"], "batch": progress["batchId"], "at": progress["timestamp"],
        "input_rows": progress.get("numInputRows", 0), "late_rows": sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
        "state_rows": sum(s.get("numRowsTotal", 0) for s in states), "watermark": progress["eventTime"]["watermark"] if known else None,
        "lag_seconds": at - known if known else None,
    }


class ProgressLog(StreamingQueryListener):
    """Writes every progress report below ``root``; a report that is written again replaces itself."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf, self.root = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(json.loads(event.progress.json))
        path = self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{row['run']}-{row['batch']:012d}.json")
        out = path.getFileSystem(self.conf).create(path, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """One row a batch and run."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).json(root)


def late_rows(progress: DataFrame) -> DataFrame:
    """(query, input_rows, late_rows, most_state, batches) over all runs of each query; a batch that ran twice counts once."""
    latest = progress.groupBy("query", "batch").agg(F.max_by(F.struct("input_rows", "late_rows", "state_rows"), "at").alias("x"))
    return latest.groupBy("query").agg(
        F.sum("x.input_rows").alias("input_rows"), F.sum("x.late_rows").alias("late_rows"), F.max("x.state_rows").alias("most_state"),
        F.count(F.lit(1)).alias("batches"),
    )


def supervise(
    start: Callable[[], StreamingQuery], policy: RestartPolicy = RestartPolicy(), sleep: Callable[[float], None] = time.sleep
) -> list[str]:
    """Runs the query that ``start`` starts until it ends by itself, restarting it after failures; returns what the failures said.
    Raises :class:`TooManyFailures` once the policy is used up."""
    failed: list[tuple[float, str]] = []
    while True:
        try:
            start().awaitTermination()
            return [why for _, why in failed]
        except StreamingQueryException as broke:
            now = time.monotonic()
            failed.append((now, str(broke)))
            recent = [at for at, _ in failed if at > now - policy.seconds]
            if len(recent) > policy.failures:
                raise TooManyFailures(f"{len(recent)} failures within {policy.seconds:g} s") from broke
            sleep(policy.pause * 2 ** (len(recent) - 1))
