"""Documents the tests of this folder share."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)
#: Names the operators use inside.
CLASHING = ("id", "x", "fp", "th", "score", "held_out", "key", "component", "rest", "lines", "size", "part", "y")


def documents(spark, rows, clashing=False):
    """(doc_id, text[, source]) rows as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        df = df.withColumns({c: F.lit("clash") for c in CLASHING})
    return df


PROSE = "the quick brown fox jumps over the lazy dog while a calm river runs past the old stone mill near town"
LONG = " ".join(f"word{i * i % 1013} and{i % 7}" for i in range(15_000))
EDGE_ROWS = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t "), (6, LONG, None), (7, LONG + " tail", None),
    (None, PROSE, "t"), (None, None, None), (8, "one"), (9, "naïve ﬁ 日本語 😀 \x00 ▁ <|endoftext|> </s>", ""),
]
