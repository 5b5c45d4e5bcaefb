"""End-to-end batch job on gzip TSV dumps: marts equal the operators, re-runs are idempotent."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from helpers import rows
from navstream.operators import clickstream as C
from navstream.operators import quality as Q
from navstream.plans.batch_job import run_batch
from navstream.settings import BatchSettings
from navstream.sources.clickstream import read_clickstream
from navstream.sources.tables import read_mart, read_quarantine


def _dump(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def _lines(month_seed: int, bad: bool):
    out = []
    for i in range(200):
        out.append(f"p{(i * month_seed) % 17}\tc{i % 23}\t{['link', 'external', 'other'][i % 3]}\t{1 + (i * 7) % 11}")
    if bad:
        out += ["\tc1\tlink\t3", "p1\tc1\tbogus\t2", "p1\tc1\tlink\t-4"]
    return out


def _settings(workdir):
    return BatchSettings(
        raw_glob=f"{workdir}/raw/clickstream-enwiki-*.tsv.gz",
        output_dir=str(workdir / "out"),
        quarantine_dir=str(workdir / "quarantine"),
        top_n=5,
    )


def test_batch_job_end_to_end(spark, workdir):
    (workdir / "raw").mkdir()
    _dump(workdir / "raw/clickstream-enwiki-2024-10.tsv.gz", _lines(3, bad=True))
    _dump(workdir / "raw/clickstream-enwiki-2024-11.tsv.gz", _lines(5, bad=True))
    settings = _settings(workdir)
    report = run_batch(spark, settings)
    assert report.raw_rows == 406 and report.quarantined_rows == 6
    assert report.months == ["2024-10", "2024-11"]

    clean = Q.clean_rows(read_clickstream(spark, settings.raw_glob))
    out = settings.output_dir
    assert rows(read_mart(spark, out, "top_articles_indegree")) == rows(
        C.top_articles_by_indegree(clean, 5).select("curr", "total_clicks", "month")
    )
    assert rows(read_mart(spark, out, "top_articles_outdegree")) == rows(
        C.top_articles_by_outdegree(clean, 5).select("prev", "total_clicks_sent", "unique_targets", "month")
    )
    assert rows(read_mart(spark, out, "top_link_pairs")) == rows(
        C.top_link_pairs(clean, 5).select("prev", "curr", "total_clicks", "month")
    )
    assert rows(read_mart(spark, out, "monthly_trend")) == rows(
        C.monthly_trend(clean, ordered=False).select("curr", "monthly_clicks", "month")
    )
    assert read_quarantine(spark, settings.quarantine_dir).count() == 6

    # Re-run of November only, now fully clean: its quarantine partition must disappear,
    # October stays untouched, marts are identical for the unchanged month.
    before_oct = rows(read_mart(spark, out, "monthly_trend").filter(F.col("month") == "2024-10"))
    (workdir / "raw/clickstream-enwiki-2024-10.tsv.gz").rename(workdir / "oct.tsv.gz.bak")
    _dump(workdir / "raw/clickstream-enwiki-2024-11.tsv.gz", _lines(5, bad=False))
    report2 = run_batch(spark, settings)
    assert report2.quarantined_rows == 0 and report2.months == ["2024-11"]
    q = read_quarantine(spark, settings.quarantine_dir)
    assert {r["month"] for r in q.collect()} == {"2024-10"}
    assert rows(read_mart(spark, out, "monthly_trend").filter(F.col("month") == "2024-10")) == before_oct
    assert read_mart(spark, out, "monthly_trend").filter(F.col("month") == "2024-11").agg(
        F.sum("monthly_clicks")
    ).first()[0] == sum(1 + (i * 7) % 11 for i in range(200))


def test_validate_and_quarantine_step(spark, workdir):
    from navstream.plans.quality_job import quarantine_report, validate_and_quarantine

    schema = "prev string, curr string, type string, n bigint, month string"
    path = str(workdir / "q")
    assert quarantine_report(spark, path).count() == 0  # nothing quarantined yet
    first = spark.createDataFrame(
        [("a", "b", "link", 1, "2024-10"), (None, "b", "link", 1, "2024-10"), ("a", "b", "bogus", 1, "2024-11")], schema
    )
    clean, n_bad = validate_and_quarantine(spark, first, path)
    assert (clean.count(), n_bad) == (1, 2)
    assert rows(quarantine_report(spark, path), "month", "_reason", "count") == [
        ("2024-10", "null_prev", 1),
        ("2024-11", "bad_type", 1),
    ]
    # November re-delivered clean: its rejects go, October's stay.
    _, n_bad = validate_and_quarantine(spark, spark.createDataFrame([("a", "b", "link", 1, "2024-11")], schema), path)
    assert n_bad == 0
    assert rows(quarantine_report(spark, path), "month") == [("2024-10",)]
    assert rows(quarantine_report(spark, path, month="2024-10"), "month") == [("2024-10",)]


def _marts(spark, out):
    names = ("monthly_trend", "top_articles_indegree", "link_pairs", "top_link_pairs", "top_articles_outdegree")
    return {n: {r["month"] for r in read_mart(spark, out, n).select("month").distinct().collect()} for n in names}


def test_rerun_drops_months_that_lost_their_rows_or_links(spark, workdir):
    schema = "prev string, curr string, type string, n bigint, month string"
    settings = _settings(workdir)
    first = [("a", "b", "link", 3, "2024-10"), ("a", "d", "link", 4, "2024-10"), ("a", "b", "link", 5, "2024-11")]
    run_batch(spark, settings, raw=spark.createDataFrame(first, schema))
    assert all(months == {"2024-10", "2024-11"} for months in _marts(spark, settings.output_dir).values())
    second = [("a", "b", "link", -3, "2024-10"), ("a", "b", "external", 5, "2024-11")]
    run_batch(spark, settings, raw=spark.createDataFrame(second, schema))
    got = _marts(spark, settings.output_dir)
    assert got["monthly_trend"] == got["top_articles_indegree"] == {"2024-11"}
    assert got["link_pairs"] == got["top_link_pairs"] == got["top_articles_outdegree"] == set()


def test_junk_months_share_one_folder_and_files_stay_few(spark, workdir):
    junk = spark.range(2_000).select(
        F.lit("a").alias("prev"), F.lit("b").alias("curr"), F.lit("link").alias("type"), F.lit(1).cast("bigint").alias("n"),
        F.concat(F.lit("junk"), F.col("id")).alias("month"),
    )
    good = junk.withColumn("month", F.lit("2024-10"))
    settings = _settings(workdir)
    report = run_batch(spark, settings, raw=junk.unionByName(good).repartition(16))
    assert report.months == ["2024-10"] and report.quarantined_rows == 2_000
    checked = workdir / "out" / "clickstream_checked"
    assert len([p for p in checked.glob("status=quarantine/month=*")]) == 1
    assert len([p for p in checked.glob("status=*/month=*/*.parquet")]) <= 4
    raw_months = read_quarantine(spark, settings.quarantine_dir).select("raw_month").distinct().count()
    assert raw_months == 2_000


def test_an_empty_delivery_writes_nothing(spark, workdir):
    empty = spark.createDataFrame([], "prev string, curr string, type string, n bigint, month string")
    report = run_batch(spark, _settings(workdir), raw=empty)
    assert (report.raw_rows, report.quarantined_rows, report.months) == (0, 0, [])


def test_no_mart_is_computed_twice_for_a_sample_of_its_ranges(spark, workdir, monkeypatch):
    (workdir / "raw").mkdir()
    _dump(workdir / "raw/clickstream-enwiki-2024-10.tsv.gz", _lines(3, bad=True))
    ranges = []
    kind = type(spark.range(1))
    real = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, *a: ranges.append(a) or real(self, *a))
    settings = _settings(workdir)
    run_batch(spark, settings)
    clean = Q.clean_rows(read_clickstream(spark, settings.raw_glob))
    assert rows(read_mart(spark, settings.output_dir, "monthly_trend"), "curr", "monthly_clicks") == rows(C.monthly_trend(clean), "curr", "monthly_clicks")
    assert read_quarantine(spark, settings.quarantine_dir).count() == 3
    assert ranges == []
