"""Helpers shared by the text operators: inputs, scratch tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.session import scratch_path

#: A word: a run of anything but ASCII space and the controls tab .. carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch. Texts run to hundreds of kilobytes, so batches stay small.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Keeps Arrow batches of whole texts within a Python worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's own switch: shuffle files of a finished query go with it instead of waiting for a garbage collection.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders written while a step is built, per open ``cut_whole``.
_BUILDING: list[list[str]] = []


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared checkpoint folder and reads it back: lineage ends there, a lost
    executor costs a re-read instead of a re-run, and the shuffles behind ``df`` leave the disk."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    if _BUILDING:
        _BUILDING[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def cut_whole(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``cut`` of what ``build`` returns; folders that building it wrote are deleted once it is written."""
    _BUILDING.append([])
    try:
        df = build()
        made = _BUILDING.pop()
    except BaseException:
        _BUILDING.pop()
        raise
    out = cut(df, name)
    _delete(spark, made)
    return out


def discard(df: DataFrame) -> None:
    """Deletes the folder behind a table that ``cut`` returned and nothing reads any more."""
    if path := getattr(df, "_scratch", None):
        _delete(df.sparkSession, [path])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; 0 is the held-out fold."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def held_out(id_col: str) -> Column:
    return F.coalesce(fold(id_col) == 0, F.lit(False))


def texts_as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def one_label(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, y) with one row per id: repeated labels average, NULL ids and NULL labels carry nothing."""
    return (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
        .where("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg(F.avg("y").alias("y"))
    )


def batches(rows: Iterator[pa.RecordBatch], size: int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``size`` rows and about ``limit`` bytes of strings (a longer row is
    a slice of its own)."""
    for batch in rows:
        weight = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                weight += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(weight)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, min(start + size, int(np.searchsorted(total, before + limit, side="right"))))
            yield batch.slice(start, end - start)
            start = end


def finite(x: np.ndarray) -> np.ndarray:
    return np.nan_to_num(x, nan=0.0, posinf=0.0, neginf=0.0)


def ragged_take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``index`` of a flat array one after the other, and where each begins (and the end)."""
    size = sizes[index]
    ends = np.r_[0, np.cumsum(size)]
    at = np.arange(ends[-1]) + np.repeat(starts[index] - ends[:-1], size)
    return values[at], ends
