"""Restarts, the progress table, and the ledger of input files."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import rows
from navstream.plans.load_job import content_digests, list_files, load_changed
from navstream.plans.upkeep_job import read_kept
from navstream.sinks.published import current_manifest
from navstream.streaming.supervision import ProgressLog, RestartPolicy, TooManyFailures, late_rows, read_progress, supervise
from test_streaming import BATCH_1, BATCH_2, _land
from navstream.operators import edits as E
from navstream.sinks.streams import parquet_append
from navstream.sources.bus import read_record_files_stream
from navstream.streaming.pipeline import silver_edits


class _Query:
    def __init__(self, fails):
        self.fails = fails

    def awaitTermination(self):
        if self.fails:
            raise StreamingQueryException("broke")


def test_restarts_stop_at_the_limit():
    outcomes, pauses = iter([True, True, False]), []
    assert len(supervise(lambda: _Query(next(outcomes)), RestartPolicy(failures=2, pause=1.0), pauses.append)) == 2
    assert pauses == [1.0, 2.0]
    with pytest.raises(TooManyFailures):
        supervise(lambda: _Query(True), RestartPolicy(failures=2, pause=0.0), pauses.append)


def test_progress_table_counts_late_rows_and_state(spark, workdir):
    log = ProgressLog(spark, str(workdir / "progress"))
    assert read_progress(spark, str(workdir / "progress")).count() == 0
    spark.streams.addListener(log)
    try:
        for name, batch in (("b1", BATCH_1), ("b2", BATCH_2)):
            _land(spark, workdir / "in", name, batch)
            rate = E.edits_per_wiki(silver_edits(read_record_files_stream(spark, f"{workdir}/in/*")), "1 minute")
            query = parquet_append(rate, str(workdir / "out"), str(workdir / "ck"), available_now=True, query_name="rate")
            query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    progress = read_progress(spark, str(workdir / "progress"))
    assert {r["query"] for r in progress.collect()} == {"rate"}
    total = late_rows(progress).first()
    assert total["input_rows"] == len(BATCH_1) + len(BATCH_2) and total["late_rows"] >= 2 and total["most_state"] > 0
    assert progress.where("watermark IS NOT NULL AND lag_seconds > 0").count() > 0


def _dump(folder, month, lines, name="clickstream-enwiki"):
    folder.mkdir(exist_ok=True)
    path = folder / f"{name}-{month}.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write("".join(f"{line}\n" for line in lines))
    return path


def test_ledger_reads_changed_dumps_only(spark, workdir):
    raw, root = workdir / "raw", str(workdir / "published")
    january = _dump(raw, "2024-01", ["a\tx\tlink\t5", "a\ty\tlink\t1"])
    _dump(raw, "2024-02", ["b\tx\tlink\t2", "bad line"])
    glob = f"{raw}/*.tsv.gz"
    totals = lambda: rows(read_kept(spark, root, "totals"), "curr", "clicks")
    first = load_changed(spark, root, glob)
    assert (first.listed, len(first.digested), first.months) == (2, 2, ["2024-01", "2024-02"]) and totals() == [("x", 7), ("y", 1)]
    version = current_manifest(spark, root).version
    again = load_changed(spark, root, glob)
    assert (again.digested, again.months) == ([], []) and current_manifest(spark, root).version == version
    # fetched anew with the same content: digested, not loaded, and known from then on
    os.utime(january, (1_000_000, 1_000_000))
    fetched = load_changed(spark, root, glob)
    assert (len(fetched.digested), fetched.months) == (1, [])
    assert load_changed(spark, root, glob).digested == []
    _dump(raw, "2024-01", ["a\tx\tlink\t50"])
    changed = load_changed(spark, root, glob)
    assert changed.months == ["2024-01"] and totals() == [("x", 52)]
    january.unlink()
    assert load_changed(spark, root, glob).months == ["2024-01"] and totals() == [("x", 2)]
    assert list_files(spark, f"{raw}/nothing*") == [] and content_digests(spark, []) == {}
    assert read_kept(spark, root, "edges").select(F.col("month")).distinct().count() == 1


class _Ended:
    isActive = False

    def __init__(self, error=None):
        self.error = error

    def exception(self):
        return self.error


def test_waiting_counts_the_given_queries_only(spark):
    from navstream.streaming.pipeline import await_any

    await_any(spark, {"a": _Ended()})
    with pytest.raises(RuntimeError, match="broke"):
        await_any(spark, {"a": _Ended(), "b": _Ended(ValueError("broke"))})
