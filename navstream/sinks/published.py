"""Tables published together: immutable run folders and one manifest that is swapped last.

A run writes its partitions below ``<root>/<table>/run=<run>/`` and then names them in the next manifest, a small JSON file
below ``<root>/_manifests``. Readers resolve the newest manifest, so they see all tables of a run or none: a run
that dies half-way leaves folders that nothing names. Partitions a run does not touch keep their folders. A manifest is bounded
by tables times partitions (months, days), never by rows.

A manifest appears by a rename that refuses to overwrite: of two publishers that started from the same manifest one
fails and starts over from the other's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"


class PublishConflict(RuntimeError):
    """Another run published since this one read its manifest."""


@dataclass(frozen=True)
class Manifest:
    """``tables``: table -> partition value -> folder below the root; ``notes``: what else commits with them."""

    version: int = 0
    tables: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)

    def partitions(self, table: str) -> dict[str, str]:
        return dict(self.tables.get(table, {}))


class _Files:
    """The few file operations of a manifest, through the Hadoop file system of the path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, below: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def names(self, below: str) -> list[str]:
        at = self.path(below)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, below: str) -> str:
        stream = self.fs.open(self.path(below))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_once(self, below: str, text: str) -> None:
        """Writes beside and renames; raises if the name is taken."""
        beside = self.path(f"{below}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.getFileSystem(self.conf).getUri(), self.conf)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(self.fs.makeQualified(beside), self.fs.makeQualified(self.path(below)), options)
        except Exception as taken:
            self.fs.delete(beside, False)
            raise PublishConflict(f"{below} is already there") from taken

    def delete(self, below: str) -> None:
        self.fs.delete(self.path(below), True)


def _manifest_names(files: _Files) -> list[str]:
    return [n for n in files.names(MANIFESTS) if n.endswith(".json")]


def current_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest, or the empty one of version 0."""
    files = _Files(spark, root)
    names = _manifest_names(files)
    if not names:
        return Manifest()
    found = json.loads(files.read(f"{MANIFESTS}/{names[-1]}"))
    return Manifest(found["version"], found["tables"], found["notes"])


def stage(df: DataFrame, root: str, table: str, run: str, partition: str, sort_by: Sequence[str] = ()) -> dict[str, str]:
    """Writes ``df`` into the run's folder of a table and returns partition value -> folder. A repeated run
    overwrites its own folder only; nothing is visible yet. Rows are clustered by partition, large partitions split by AQE."""
    at = f"{table}/run={run}"
    shaped = df.hint("rebalance", partition).sortWithinPartitions(partition, *sort_by)
    shaped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(f"{root.rstrip('/')}/{at}")
    files = _Files(df.sparkSession, root)
    folders = [n for n in files.names(at) if n.startswith(f"{partition}=")]
    return {n.split("=", 1)[1]: f"{at}/{n}" for n in folders}


def publish(
    spark: SparkSession, root: str, base: Manifest, changes: Mapping[str, Mapping[str, str | None]], notes: Mapping[str, object] | None = None
) -> Manifest:
    """Swaps in the manifest after ``base``: changed partitions point to their new folders, those changed to None are
    gone, all others stay. Raises :class:`PublishConflict` if ``base`` is no longer the newest."""
    tables = {name: dict(parts) for name, parts in base.tables.items()}
    for name, parts in changes.items():
        held = tables.setdefault(name, {})
        for value, folder in parts.items():
            if folder is None:
                held.pop(value, None)
            else:
                held[value] = folder
    made = Manifest(base.version + 1, tables, {**base.notes, **(notes or {})})
    text = json.dumps({"version": made.version, "tables": made.tables, "notes": made.notes}, sort_keys=True)
    _Files(spark, root).write_once(f"{MANIFESTS}/{made.version:012d}.json", text)
    return made


def read_published(
    spark: SparkSession, root: str, table: str, schema: T.StructType, partition: str, only: Iterable[str] | None = None, manifest: Manifest | None = None
) -> DataFrame:
    """A published table (or some partitions) as of a manifest, the newest by default; empty if it is not published.
    ``schema`` has the partition column; only the folders asked for are listed and read."""
    held = (manifest or current_manifest(spark, root)).partitions(table)
    asked = held if only is None else set(only)
    folders = [folder for value, folder in sorted(held.items()) if value in asked]
    if not folders:
        # the filter tells the optimizer that there are no rows: unions with it cost no exchange
        return spark.createDataFrame([], schema).where(F.lit(False))
    base = f"{root.rstrip('/')}/{table}"
    wide = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    found = spark.read.schema(wide).option("basePath", base).parquet(*[f"{root.rstrip('/')}/{f}" for f in folders])
    return found.select(*schema.fieldNames())


def vacuum(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Deletes manifests before the newest ``keep`` and the run folders that none of those kept names. Run
    it by the publisher, between runs: a run under way is not named yet."""
    files = _Files(spark, root)
    names = _manifest_names(files)
    live = [json.loads(files.read(f"{MANIFESTS}/{n}"))["tables"] for n in names[-keep:]]
    named = {"/".join(f.split("/")[:2]) for tables in live for parts in tables.values() for f in parts.values()}
    gone = []
    for table in (t for t in files.names("") if t != MANIFESTS):
        gone += [f"{table}/{run}" for run in files.names(table) if run.startswith("run=") and f"{table}/{run}" not in named]
    for below in gone + [f"{MANIFESTS}/{n}" for n in names[:-keep]]:
        files.delete(below)
    return gone
