"""Registered forms of the operators: whole tables, production parameters, digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.llm.common import cut, table
from navstream.llm.e8_dedup import embedding_groups
from navstream.llm.fill_middle import fill_in_middle, restored
from navstream.llm.prefix_doubling import remove_repeats
from navstream.llm.prefix_trie import prefix_trie
from navstream.llm.quality_classifier import quality_scores
from navstream.llm.quality_rules import BASE, MEASURES, RULES, V1, ablation, apply_policies, rule_ledger
from navstream.llm.sentencepiece_codec import encode_documents
from navstream.llm.simhash_golay import simhash_groups
from navstream.llm.source_mix import mix_sources
from navstream.llm.token_counts import token_counts
from navstream.llm.toxicity import toxicity_scores
from navstream.llm.unit_dedup import dedup_units
from navstream.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark, sf_dir):
    """Every document's ledger row under the base rules and the full policy, and the ablation of the full policy read
    off the ledger: the rule that alone rejects the document, and how many documents the policy would keep beside its own without that rule."""
    ledger = cut(apply_policies(rule_ledger(table(spark, sf_dir, "documents")), (BASE, V1)), "rules-ledger")
    # one row a rule
    freed = F.broadcast(ablation(ledger).select(F.col("rule").alias("sole_rule"), F.col("rejected_alone").alias("freed_without_rule")))
    sole = F.coalesce(*[F.when(F.col("fail_bits") == r.mask, F.lit(r.name)) for r in RULES])
    return (
        ledger.withColumn("sole_rule", sole).join(freed, "sole_rule", "left")
        .select("doc_id", *MEASURES[:5], (~F.col("kept_base")).alias("base_failed"), F.col("kept_v1").alias("kept"), "fail_bits", "sole_rule", "freed_without_rule")
    )


def op2_sentencepiece(spark, sf_dir):
    """Every document's ids under the piece vocabulary, and whether they decode to the very text. The vocabulary is a BPE model, so
    the pass keeps the one admissible predecessor in place of a best score (``sentencepiece_codec``)."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_source_mix(spark, sf_dir):
    """Every document's copies in the mix of sources. A NULL text has size 0, a NULL source comes last."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "rate")


def op4_quality_classifier(spark, sf_dir):
    """Every document's calibrated quality score; a NULL text scores as an empty one."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark, sf_dir):
    """Every document's calibrated toxicity score; a NULL text scores as an empty one."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark, sf_dir):
    """How many words of every document repeat an earlier place of the corpus, and a digest of the text without them."""
    done = dedup_units(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_token_counts(spark, sf_dir):
    """Every document's tokens under the byte-level vocabulary; a NULL text has none."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_embedding_near_dedup(spark, sf_dir):
    """Every vector's links and component; a vector that cannot be compared stands alone."""
    found = embedding_groups(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op9_simhash_near_dedup(spark, sf_dir):
    """Every document's fingerprint and component; wordless texts have fingerprint zero."""
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op10_suffix_array_dedup(spark, sf_dir):
    """Every document without the bytes of 50-byte strings that start in a smaller id; a NULL text is empty."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_fill_middle(spark, sf_dir):
    """Every document in fill-in-middle form: cut points, and digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )


def op12_prefix_trie(spark, sf_dir):
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_url_filter(spark, sf_dir):
    """Every page's host, path, rule and verdict, and the URL that names its group of aliases."""
    judged = judge_urls(table(spark, sf_dir, "pages"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "alias_of")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_sentencepiece, op3_source_mix, op4_quality_classifier, op5_toxicity, op6_substring_dedup,
        op7_token_counts, op8_embedding_near_dedup, op9_simhash_near_dedup, op10_suffix_array_dedup,
        op11_fill_middle, op12_prefix_trie, op13_url_filter,
    )
}
