"""The events table as a feed: slices in order of time, later slices delivering rows of earlier ones again."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.session import ensure_utc, run_folder
from navstream.sources import standins
from navstream.sources.bus import RECORD_SCHEMA

SLICES = 6
#: Files of a slice: that many tasks write it, and a trigger reads them together.
FILES = 4
DELIVERY = "delivery"


def _stamp_in_order(spark: SparkSession, path: str) -> None:
    """File times by delivery: the file source reads older files first. Needs a file system whose times can be set (HDFS, local)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    start = int(time.time() * 1000) - 3_600_000
    for folder in fs.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith(f"{DELIVERY}="):
            for file in fs.listStatus(folder.getPath()):
                fs.setTimes(file.getPath(), start + 10_000 * int(name.split("=")[1]), -1)


def record_stream_in_slices(spark: SparkSession, sf_dir: str, name: str, recent_seconds: int = 300) -> DataFrame:
    """The events as SLICES deliveries in order of time, one to a trigger. A delivery repeats a tenth of the slice before it, most of it
    behind the watermark by then, and all of its last ``recent_seconds``, which a dedup still remembers.

    Every row of the table is read once, and a delivery is FILES files wide.
    """
    ensure_utc(spark)
    events = standins.table(spark, sf_dir, "events").withColumn("s", F.unix_seconds(F.col("ts").cast("timestamp")))
    low, high = events.agg(F.min("s"), F.max("s")).first()
    low, width = low or 0, ((high or 0) - (low or 0)) // SLICES + 1
    slice_no = F.floor((F.col("s") - low) / width).cast("int")
    ends = F.lit(low) + (slice_no + 1) * width
    again = ((F.col("event_id") % 10 == 0) | (F.col("s") > ends - recent_seconds)) & (slice_no < SLICES - 1)
    deliveries = F.when(again, F.array(slice_no, slice_no + 1)).otherwise(F.array(slice_no))
    placed = events.withColumn(DELIVERY, F.explode(deliveries))
    records = standins.edit_records_from_events(placed, carry=(DELIVERY,))
    path = f"{run_folder(spark, name + '-feed')}/records"
    records.repartition(FILES).write.partitionBy(DELIVERY).parquet(path)
    _stamp_in_order(spark, path)
    stream = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", FILES)
    return stream.parquet(f"{path}/{DELIVERY}=*")
