"""Lookups by title through an index of files.

For every data file the index holds the least and greatest title and a Bloom filter of its titles. A lookup reads the index, asks which
files may hold the title, and opens those alone. The filter is made of bitmaps of BITMAP bits built by Spark's own bitmap aggregate: a title sets
one bit in each of HASHES places of the file's filter, and a file has ``maps`` bitmaps, sized for its number of distinct titles. A
filter never denies a title that is there; it lets a wrong file through in about one of a hundred cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one of Spark's bitmaps, hash functions, and bits a title.
BITMAP, HASHES, BITS_PER_TITLE = 32_768, 7, 10
INDEX_SCHEMA = "file string, low string, high string, maps long, map_no long, bits binary"


def _places(title: Column, maps: Column) -> Column:
    """Places of a title among the bits of a filter of so many bitmaps."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), title), maps * BITMAP) for k in range(HASHES)])


def file_index(table: DataFrame, title: str) -> DataFrame:
    """(file, low, high, maps, map_no, bits) of the files a table is read from: one row a bitmap."""
    titles = table.select(F.col("_metadata.file_path").alias("file"), F.col(title).alias("t")).where("t IS NOT NULL").distinct()
    sizes = titles.groupBy("file").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("maps", F.ceil(F.col("n") * BITS_PER_TITLE / BITMAP).cast("long")).drop("n")
    placed = titles.join(sizes, "file").select("file", "low", "high", "maps", F.explode(_places(F.col("t"), F.col("maps"))).alias("place"))
    bitmap = F.bitmap_construct_agg(F.pmod("place", F.lit(BITMAP))).alias("bits")
    return placed.groupBy("file", "low", "high", "maps", F.floor(F.col("place") / BITMAP).cast("long").alias("map_no")).agg(bitmap)


def files_that_may_hold(index: DataFrame, titles: Sequence[str]) -> list[str]:
    """Files that some of a few titles may be in; as many rows come to the driver."""
    spark = index.sparkSession
    wanted = spark.createDataFrame([(t,) for t in titles], "t string")
    within = index.join(F.broadcast(wanted), (F.col("t") >= F.col("low")) & (F.col("t") <= F.col("high")))
    place = F.explode(F.array_distinct(_places(F.col("t"), F.col("maps")))).alias("place")
    asked = within.select("file", "t", "map_no", "bits", place).where(F.floor(F.col("place") / BITMAP) == F.col("map_no"))
    at = F.pmod("place", F.lit(BITMAP))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))).cast("int") % 2
    # every place of the title has to be set; a bitmap without any bit of the file has no row
    sought = within.select("file", "t", F.size(F.array_distinct(_places(F.col("t"), F.col("maps")))).alias("need")).distinct()
    found = asked.groupBy("file", "t").agg(F.sum(bit).cast("int").alias("set"))
    held = found.join(sought, ["file", "t"]).where(F.col("set") == F.col("need"))
    return sorted(r["file"] for r in held.select("file").distinct().collect())


def lookup(spark: SparkSession, path: str, schema: str, index: DataFrame, column: str, titles: Sequence[str]) -> DataFrame:
    """Rows of a few titles, from the files that may hold them."""
    files = files_that_may_hold(index, titles)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files).where(F.col(column).isin(list(titles)))
