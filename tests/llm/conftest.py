from __future__ import annotations

import pytest
from conftest_llm import EDGE_ROWS, documents


@pytest.fixture()
def edge_docs(spark):
    return documents(spark, EDGE_ROWS, clashing=True)


@pytest.fixture()
def no_docs(spark):
    return documents(spark, [], clashing=True)


@pytest.fixture()
def edge_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(1, 0, 1), (None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
