"""Every registered query equals its DuckDB SQL oracle on the sf0.01 tables (rows, columns, values)."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import SF_ORACLE, SF_SMALL

QUERIES = entry.QUERIES
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "curr", "total_clicks"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_ORACLE)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _canon(got, df.columns) == _canon(want, cols)


#: Query -> (column, descending) by which its rows are sorted.
SORTED = {
    "monthly_trend": (("curr", False), ("month", False)),
    "months_loaded": (("month", False),),
    "month_picker": (("month", True),),
    "dq_summary": (("month", False), ("count", True)),
    "dash_trend_top10": (("month", False), ("curr", False)),
    "dash_trend_top10_threshold": (("month", False), ("curr", False)),
    "edit_rate_series": (("window_start", False),),
}


@pytest.mark.parametrize("name", sorted(SORTED))
def test_sorted_queries_come_in_order(spark, name):
    got = [r.asDict() for r in entry.queries()[name](spark, SF_ORACLE).collect()]
    want = got
    for column, descending in reversed(SORTED[name]):  # stable: the last key first
        want = sorted(want, key=lambda r: r[column], reverse=descending)
    keys = [c for c, _ in SORTED[name]]
    assert got and [[r[c] for c in keys] for r in got] == [[r[c] for c in keys] for r in want]


@pytest.mark.parametrize("name", ["top_articles_indegree", "dq_counts", "edits_per_wiki_stream"])
def test_queries_run_on_smallest_tables(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() >= 0
