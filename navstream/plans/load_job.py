"""Incremental loading of monthly dumps: a ledger of input files decides what is read.

The ledger keeps path, size, modification time and a content digest of every file that was loaded, and commits with the marts, in the
manifest. A run lists the dumps and reads none whose size and time the ledger knows. Of the others it takes a digest (one aggregation over
their lines); months whose content did not change, a dump fetched anew, say, only get their ledger entry renewed. Months with new, changed or
vanished files are loaded as whole deliveries, from their own files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.operators.quality import clean_rows
from navstream.plans.upkeep_job import apply_delivery
from navstream.settings import MONTH_FROM_PATH_PATTERN
from navstream.sinks.published import current_manifest, publish
from navstream.sources.clickstream import read_clickstream

FILES = "files"


@dataclass(frozen=True)
class InputFile:
    path: str
    size: int
    modified: int
    month: str
    digest: str = ""


@dataclass
class LoadReport:
    listed: int = 0
    digested: list[str] = field(default_factory=list)
    months: list[str] = field(default_factory=list)


def list_files(spark: SparkSession, glob: str, month_pattern: str = MONTH_FROM_PATH_PATTERN) -> list[InputFile]:
    """The dumps a glob names, without reading them; as many as months (and wikis). Files without a month are left out."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(path) or []:
        name = status.getPath().toString()
        if (month := re.search(month_pattern, name)) and not status.isDirectory():
            found.append(InputFile(name, status.getLen(), status.getModificationTime(), month.group(1)))
    return found


def content_digests(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Path -> digest of its lines, whatever their order: number, and sum and XOR of two hashes. One row a file comes back."""
    if not paths:
        return {}
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    sums = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("value")).alias("x"),
        F.sum(F.xxhash64(F.lit(1), "value").cast("decimal(38, 0)")).alias("s"),
    )
    known = {_plain(r["path"]): f"{r['n']}:{r['x']}:{r['s']}" for r in sums.collect()}
    return {p: known.get(_plain(p), "0") for p in paths}


def _plain(path: str) -> str:
    """A path without its scheme's empty authority, which the listing and the scan spell in two ways."""
    return re.sub(r"^file:/*", "/", path)


def load_changed(
    spark: SparkSession, root: str, glob: str, month_pattern: str = MONTH_FROM_PATH_PATTERN, top_n: int = 50
) -> LoadReport:
    """Brings the published marts below ``root`` up to the dumps a glob names."""
    base = current_manifest(spark, root)
    known = {p: InputFile(p, *entry) for p, entry in dict(base.notes.get(FILES, {})).items()}
    listed = list_files(spark, glob, month_pattern)
    fresh = [f for f in listed if f.path not in known or (known[f.path].size, known[f.path].modified) != (f.size, f.modified)]
    digests = content_digests(spark, [f.path for f in fresh])
    now = {f.path: InputFile(f.path, f.size, f.modified, f.month, digests.get(f.path) or known[f.path].digest) for f in listed}
    changed = {f.month for p, f in now.items() if p not in known or known[p].digest != f.digest}
    changed |= {f.month for p, f in known.items() if p not in now}
    report = LoadReport(len(listed), sorted(digests), sorted(changed))
    notes = {FILES: {p: [f.size, f.modified, f.month, f.digest] for p, f in now.items()}}
    if changed:
        paths = [f.path for f in listed if f.month in changed]
        apply_delivery(spark, root, _clean(spark, paths, month_pattern), report.months, top_n, notes=notes, base=base)
    elif now != known:
        publish(spark, root, base, {}, notes)
    return report


def _clean(spark: SparkSession, paths: list[str], month_pattern: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "prev string, curr string, type string, n long, month string")
    return clean_rows(read_clickstream(spark, paths, month_pattern))
