"""TSV scan (quotes, short rows, month from path), guarded mart reads, clustered idempotent writes."""

from __future__ import annotations

import gzip
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import rows
from navstream.schemas import MART_SCHEMAS
from navstream.sinks.tables import drop_partitions, write_partitioned
from navstream.sources.clickstream import clickstream_glob, read_clickstream
from navstream.sources.tables import read_mart, read_quarantine, read_table

LINES = [
    "A\tB\tlink\t5",
    '"Heroes"\tB\tlink\t7',
    '"Open_quote\tC\tlink\t3',
    "\tB\tlink\t2",
    "A\tB\tlink\tabc",
    "A\tB\tlink",
]


def _write_dump(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_scan_keeps_quotes_and_nulls_bad_fields(spark, workdir):
    _write_dump(workdir, "clickstream-enwiki-2024-10.tsv.gz", LINES)
    df = read_clickstream(spark, clickstream_glob(str(workdir)))
    got = rows(df, "prev", "curr", "type", "n", "month")
    assert ('"Heroes"', "B", "link", 7, "2024-10") in got
    assert ('"Open_quote', "C", "link", 3, "2024-10") in got  # not swallowed
    assert (None, "B", "link", 2, "2024-10") in got
    assert ("A", "B", "link", None, "2024-10") in got  # unparsable n and short row
    assert len(got) == len(LINES)


def test_month_from_path_and_unmatched(spark, workdir):
    _write_dump(workdir, "clickstream-enwiki-2024-11.tsv.gz", LINES[:1])
    _write_dump(workdir, "clickstream-enwiki-latest.tsv.gz", LINES[:1])
    df = read_clickstream(spark, f"{workdir}/clickstream-enwiki-*.tsv.gz")
    assert sorted(r["month"] for r in df.collect()) == ["", "2024-11"]


def test_scan_partitions_option(spark, workdir):
    _write_dump(workdir, "clickstream-enwiki-2024-12.tsv.gz", LINES)
    df = read_clickstream(spark, clickstream_glob(str(workdir)), scan_partitions=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == len(LINES)


def test_missing_mart_reads_empty_with_schema(spark, workdir):
    df = read_mart(spark, str(workdir), "top_articles_indegree")
    assert df.count() == 0 and df.schema == MART_SCHEMAS["top_articles_indegree"]
    assert read_quarantine(spark, str(workdir / "nope")).count() == 0


def _marts(spark):
    data = [(f"c{i % 7}", i, f"2024-{10 + i % 3:02d}") for i in range(60)]
    return spark.createDataFrame(data, "curr string, total_clicks bigint, month string")


def test_clustered_write_sorted_files(spark, workdir):
    path = str(workdir / "mart")
    write_partitioned(_marts(spark), path, sort_by=("curr",), num_partitions=4)
    month_dirs = sorted(p for p in os.listdir(path) if p.startswith("month="))
    assert month_dirs == ["month=2024-10", "month=2024-11", "month=2024-12"]
    for d in month_dirs:
        files = [f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
        assert len(files) <= 2  # range partitioning: no file per task per month
        for f in files:
            currs = pq.read_table(f"{path}/{d}/{f}").column("curr").to_pylist()
            assert currs == sorted(currs)


def test_rewrite_replaces_only_own_months(spark, workdir):
    path = str(workdir / "mart")
    write_partitioned(_marts(spark), path, sort_by=("curr",))
    only_oct = spark.createDataFrame([("new", 1, "2024-10")], "curr string, total_clicks bigint, month string")
    write_partitioned(only_oct, path, sort_by=("curr",))
    df = read_table(spark, path, MART_SCHEMAS["top_articles_indegree"])
    assert rows(df.filter(F.col("month") == "2024-10"), "curr") == [("new",)]
    assert df.filter(F.col("month") == "2024-11").count() == 20
    # twice the same write gives the same table
    write_partitioned(only_oct, path, sort_by=("curr",))
    assert read_table(spark, path, MART_SCHEMAS["top_articles_indegree"]).count() == 41


def test_drop_partitions(spark, workdir):
    path = str(workdir / "mart")
    write_partitioned(_marts(spark), path)
    removed = drop_partitions(spark, path, "month", ["2024-11", "1999-01"])
    assert len(removed) == 1
    assert spark.read.parquet(path).filter(F.col("month") == "2024-11").count() == 0


def test_default_partition_reads_back_null(spark, workdir):
    path = str(workdir / "q")
    df = spark.createDataFrame([("a", "b", "link", 1, "x", "junk", "")], MART_SCHEMAS["quarantine"])
    write_partitioned(df, path, sort_by=("_reason",))
    assert read_quarantine(spark, path).first()["month"] is None
    drop_partitions(spark, path, "month", [""])
    assert read_quarantine(spark, path).count() == 0
