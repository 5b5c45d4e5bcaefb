"""The corpus pipeline: five stages over ``documents``, each on all its predecessor kept.

Every stage but the last returns the columns of its input. Rows are told apart by id and a hash of the text, so
repeated and NULL ids pass through every stage. NULL, empty, wordless and very long texts are documents like any other, read
whole; columns besides those of ``documents`` are carried; an empty input passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navstream.llm.common import cut_whole, discard, table
from navstream.llm.sentencepiece_codec import encode_documents
from navstream.llm.simhash_golay import simhash_groups
from navstream.llm.source_mix import mix_sources
from navstream.llm.toxicity import toxicity_scores
from navstream.llm.unit_dedup import dedup_units


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier rejects go. A NULL text is scored as an empty one; rows of one id are judged one by one."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)  # input columns cannot clash with the operator's
    at = dict(zip(docs.columns, names, strict=True))
    scored = toxicity_scores(plain, table(spark, sf_dir, "labels"), at["doc_id"], at["text"], keep=names)
    return scored.where("predicted = 0").select(*names).toDF(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one of the smallest id (a group without ids: of the smallest
    fingerprint and text hash), by id and text, so a repeated id does not keep another group's text. Of rows equal
    in id and text one stays. NULL and wordless texts share the fingerprint zero and are one group."""
    found = simhash_groups(docs)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "fp", "th")).alias("first"))
    winners = first.select(F.col("first.id").alias("first__"), F.col("first.th").alias("text__")).distinct()
    keyed = docs.withColumn("th__", F.xxhash64("text"))
    kept = keyed.join(winners, keyed["doc_id"].eqNullSafe(winners["first__"]) & (keyed["th__"] == winners["text__"]), "left_semi")
    # equal rows are combined before the shuffle, however many there are
    one = kept.groupBy("doc_id", "th__").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row__"))
    return one.select("row__.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines and passages that an earlier place of the corpus holds; the length column follows the text. A NULL
    text stays NULL, a text may become empty, no row goes."""
    done = dedup_units(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text")])
    own = {"doc_id": F.col("id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*[own.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Equal rows share their copies evenly; a document without words is never taken; a NULL
    source is a source of its own."""
    keyed = docs.withColumn("key__", F.struct("doc_id", F.xxhash64("text").alias("th"), F.xxhash64("source").alias("sh")))
    copies = (
        mix_sources(keyed, "key__").groupBy("id").agg(F.sum("copies").alias("copies__"), F.count(F.lit(1)).alias("rows__"))
        .where("copies__ > 0")
        .select(F.col("id.doc_id").alias("d__"), F.col("id.th").alias("t__"), F.col("id.sh").alias("s__"), "copies__", "rows__")
    )
    same = (
        keyed["key__"]["doc_id"].eqNullSafe(copies["d__"]) & (keyed["key__"]["th"] == copies["t__"]) & (keyed["key__"]["sh"] == copies["s__"])
    )
    joined = keyed.join(copies, same)
    # equal rows share their copies evenly, the first ones taking what is left over
    number = F.when(F.col("rows__") > 1, F.row_number().over(Window.partitionBy("d__", "t__", "s__").orderBy("t__"))).otherwise(1)
    own = F.floor((F.col("copies__") + F.col("rows__") - number) / F.col("rows__"))
    return joined.withColumn("own__", own).where("own__ > 0").withColumn("n__", F.explode(F.sequence(F.lit(1), F.col("own__").cast("int")))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document under the piece vocabulary. A NULL text has none; repeated ids are encoded row by row."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("source_mix", mix),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. A stage's scratch, and its input, are deleted once what it returns is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = docs
        docs = cut_whole(spark, f"pipeline-{name}", lambda run=stage, own=docs: run(spark, own, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Models, fuzzy keys and tokenisation are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
