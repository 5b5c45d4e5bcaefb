"""Monthly navigation dumps: header-less TSV (usually .tsv.gz), one file per wiki and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.schemas import CLICKSTREAM_SCHEMA
from navstream.settings import MONTH_FROM_PATH_PATTERN


def read_clickstream(
    spark: SparkSession,
    path_glob: str,
    month_pattern: str = MONTH_FROM_PATH_PATTERN,
    scan_partitions: int | None = None,
) -> DataFrame:
    """``prev, curr, type, n, month`` from every file matching ``path_glob``.

    * Quoting is off: titles legitimately start with ``"``, and with the CSV default an
      unbalanced quote would swallow the rest of the line into one field.
    * Short rows, empty fields and unparsable counts become NULL and are caught by the contract.
    * ``month`` comes from the file path (``_metadata.file_path``); no match yields ''.
    * A .gz file is one scan task. Downstream aggregations combine map-side, so by default the
      scan is not re-shuffled; ``scan_partitions`` adds a round-robin repartition for inputs with
      few, very large files.
    """
    df = (
        spark.read.option("sep", "\t")
        .option("header", "false")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .schema(CLICKSTREAM_SCHEMA)
        .csv(path_glob)
    )
    df = df.select(
        *CLICKSTREAM_SCHEMA.fieldNames(),
        F.regexp_extract(F.col("_metadata.file_path"), month_pattern, 1).alias("month"),
    )
    return df.repartition(scan_partitions) if scan_partitions else df


def clickstream_glob(raw_dir: str, wiki: str = "enwiki") -> str:
    """All months of one wiki."""
    return f"{raw_dir.rstrip('/')}/clickstream-{wiki}-*.tsv.gz"
