"""Files chosen by an index of titles, and row groups skipped in both directions."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq

from helpers import rows
from navstream.operators.layout import boundaries, clustered_both_ways, interleaved, rank
from navstream.sources import lookup as L
from pyspark.sql import functions as F

SCHEMA = "curr string, n long"


def _table(spark, path, files=24):
    rng = random.Random(8)
    data = [(f"t{rng.randint(0, 4000):04d}", k) for k in range(6000)] + [(None, 1), ("", 2), ("é", 3)]
    spark.createDataFrame(data, SCHEMA).repartition(files).write.parquet(path)  # titles lie anywhere: ranges do not help
    return data


def test_lookup_reads_few_files_and_loses_no_row(spark, workdir):
    path = str(workdir / "t")
    data = _table(spark, path)
    index = L.file_index(spark.read.schema(SCHEMA).parquet(path), "curr")
    index.write.parquet(f"{path}_index")
    index = spark.read.schema(L.INDEX_SCHEMA).parquet(f"{path}_index")
    read = 0
    for titles in (["t0007"], ["t0100", "t3999"], [""], ["é"], ["absent", "t9999"]):
        found = L.lookup(spark, path, SCHEMA, index, "curr", titles)
        assert rows(found) == sorted([r for r in data if r[0] in titles], key=repr)
        held = {r["f"] for r in spark.read.schema(SCHEMA).parquet(path).where(F.col("curr").isin(titles)).select(F.col("_metadata.file_path").alias("f")).collect()}
        chosen = L.files_that_may_hold(index, titles)
        assert held <= set(chosen)
        read += len(chosen) - len(held)
    assert read <= 3  # wrong files, of 120 asked


def test_filters_of_several_bitmaps(spark, workdir, monkeypatch):
    path = str(workdir / "t")
    data = [(f"x{k}", k) for k in range(9000)]
    spark.createDataFrame(data, SCHEMA).repartition(2).write.parquet(path)
    index = L.file_index(spark.read.schema(SCHEMA).parquet(path), "curr").cache()
    assert index.agg(F.max("maps")).first()[0] > 1
    for title in ("x0", "x4711", "x8999"):
        assert rows(L.lookup(spark, path, SCHEMA, index, "curr", [title])) == [(title, int(title[1:]))]


def _groups_read(folder, column, value):
    """Row groups whose statistics do not rule a value out."""
    read = total = 0
    for file in Path(folder).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns) if meta.schema.column(c).name == column)
            total += 1
            read += stats.min <= value <= stats.max
    return read, total


def test_pairs_are_skipped_in_both_directions(spark, workdir):
    rng = random.Random(9)
    data = [(f"p{rng.randint(0, 999):03d}", f"c{rng.randint(0, 999):03d}", k) for k in range(40_000)] + [(None, "c1", 0), ("p1", None, 0)]
    pairs = spark.createDataFrame(data, "prev string, curr string, n long")
    clustered_both_ways(pairs, 64).write.parquet(str(workdir / "curve"))
    pairs.repartitionByRange(64, "prev", "curr").sortWithinPartitions("prev", "curr").write.parquet(str(workdir / "line"))
    assert rows(spark.read.parquet(str(workdir / "curve"))) == rows(pairs)
    for value in ("500", "123", "987"):
        by_prev, files = _groups_read(workdir / "curve", "prev", f"p{value}")
        by_curr, _ = _groups_read(workdir / "curve", "curr", f"c{value}")
        line_curr, _ = _groups_read(workdir / "line", "curr", f"c{value}")
        assert by_prev <= files / 3 and by_curr <= files / 3 and line_curr > files * 0.9


def test_ranks_and_curve(spark):
    df = spark.createDataFrame([(f"{k:03d}",) for k in range(500)] + [(None,)], "v string")
    bounds = boundaries(df, "v", 3)
    assert bounds == sorted(bounds) and len(bounds) == 7
    got = df.withColumn("r", rank("v", bounds)).collect()
    assert all(r["r"] == (0 if r["v"] is None else sum(b <= r["v"] for b in bounds)) for r in got)
    grid = spark.range(64).select(F.floor(F.col("id") / 8).alias("a"), (F.col("id") % 8).alias("b"))
    keys = {(r["a"], r["b"]): r["k"] for r in grid.withColumn("k", interleaved(F.col("a"), F.col("b"), 3)).collect()}
    assert sorted(keys.values()) == list(range(64)) and keys[0, 1] == 1 and keys[1, 0] == 2 and keys[7, 7] == 63
    assert boundaries(df.limit(0), "v") == []
