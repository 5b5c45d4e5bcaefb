"""Re-reading written marts and the quarantine with their declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from navstream.schemas import MART_SCHEMAS


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table at ``path`` read with ``schema``; an empty frame of that schema if absent.

    The declared schema keeps partition values typed as written (``month`` stays a string) and
    lets a missing table read as empty instead of failing.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the named marts below ``root``."""
    return read_table(spark, f"{root.rstrip('/')}/{name}", MART_SCHEMAS[name])


def read_quarantine(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """Quarantined rows, optionally one month (pruned to that partition at the scan)."""
    df = read_table(spark, path, MART_SCHEMAS["quarantine"])
    return df.filter(df.month == month) if month else df
