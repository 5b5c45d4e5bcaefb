"""Update-mode marts: changed windows of every micro-batch replace their older rows in a published table.

In append mode a window shows once it has closed. Here a window shows from its first event on: the stream runs in update mode,
``foreachBatch`` merges the changed rows into the partitions (days) they belong to, and the manifest that publishes the
merged partitions also records the batch id. A batch that is delivered again, because the stream stopped between the
merge and its own commit, finds its id recorded and changes nothing; one that stopped before is merged anew into the same folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from navstream.sinks.published import current_manifest, publish, read_published, stage, vacuum

DAY = "day"
#: Manifests kept, so that readers of an older one still find its folders.
KEPT = 5


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])


def merge_batch(changed: DataFrame, batch_id: int, root: str, table: str, keys: Sequence[str], time_col: str) -> bool:
    """Merges one batch of changed rows, one per key; False if the ledger has the batch already."""
    spark = changed.sparkSession
    base = current_manifest(spark, root)
    ledger = f"batches/{table}"
    if batch_id <= int(base.notes.get(ledger, -1)):
        # the state behind the batch has to advance all the same
        changed.write.format("noop").mode("overwrite").save()
        return False
    schema = _with_day(changed.schema)
    # written once: the state behind an aggregate must not be computed again for every use of the batch
    fresh = stage(changed.withColumn(DAY, F.date_format(time_col, "yyyy-MM-dd")), root, f"_changed-{table}", str(batch_id), DAY)
    if not fresh:
        publish(spark, root, base, {}, {ledger: batch_id})
        return True
    new = spark.read.schema(schema).option("basePath", f"{root}/_changed-{table}/run={batch_id}").parquet(*[f"{root}/{f}" for f in fresh.values()])
    held = read_published(spark, root, table, schema, DAY, only=fresh, manifest=base)
    # Windows belong to one day, so only the days of the batch are read and written again.
    same = [held[k].eqNullSafe(new[k]) for k in (*keys, DAY)]
    merged = held.join(new, same, "left_anti").unionByName(new)
    changes = stage(merged, root, table, str(batch_id), DAY, sort_by=(time_col,))
    publish(spark, root, base, {table: changes}, {ledger: batch_id})
    vacuum(spark, root, KEPT)
    return True


def upsert_mart(
    mart: DataFrame, root: str, table: str, checkpoint: str, keys: Sequence[str], time_col: str = "window_start",
    trigger_seconds: int | None = 30, available_now: bool = False,
) -> StreamingQuery:
    """Starts the update-mode stream of one mart. ``keys`` tell its rows apart; one table to a root."""

    def merge(changed: DataFrame, batch_id: int) -> None:
        merge_batch(changed, batch_id, root.rstrip("/"), table, keys, time_col)

    return _started(mart.writeStream.outputMode("update").foreachBatch(merge), checkpoint, trigger_seconds, available_now)


def _started(writer, checkpoint: str, trigger_seconds: int | None, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return (writer.trigger(processingTime=f"{trigger_seconds} seconds") if trigger_seconds else writer).start()


def read_upserted(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """All windows known so far, open ones too."""
    return read_published(spark, root, table, _with_day(schema), DAY).select(*schema.fieldNames())

