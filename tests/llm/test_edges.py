"""Every operator on awkward rows (NULLs, empty and long texts, repeated rows, clashing names) and on no rows."""

from __future__ import annotations

import public_tokenizers
import pytest
from conftest_llm import EDGE_ROWS, documents

import corpus_pipeline
from navstream.llm.prefix_doubling import remove_repeats
from navstream.llm.quality_classifier import quality_scores
from navstream.llm.quality_rules import apply_policies, rule_ledger
from navstream.llm.sentencepiece_codec import decode_documents, encode_documents
from navstream.llm.simhash_golay import simhash_groups
from navstream.llm.source_mix import mix_sources
from navstream.llm.token_counts import token_counts
from navstream.llm.toxicity import toxicity_scores
from navstream.llm.unit_dedup import dedup_units

MODEL = public_tokenizers.path("piece_bpe_32k.model")
OPERATORS = {
    "rules": lambda d, y: apply_policies(rule_ledger(d)),
    "encode": lambda d, y: encode_documents(d, MODEL),
    "mix": lambda d, y: mix_sources(d),
    "quality": quality_scores,
    "toxicity": toxicity_scores,
    "units": lambda d, y: dedup_units(d),
    "tokens": lambda d, y: token_counts(d, public_tokenizers.path("byte_bpe_50k.json")),
    "simhash": lambda d, y: simhash_groups(d),
    "repeats": lambda d, y: remove_repeats(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, edge_docs, edge_labels, name):
    assert len(OPERATORS[name](edge_docs, edge_labels).collect()) == len(EDGE_ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, no_docs, edge_labels, name):
    assert OPERATORS[name](no_docs, edge_labels.limit(0)).collect() == []


def test_models_without_labels_score_alike(spark, edge_docs, edge_labels):
    assert {r["score"] for r in quality_scores(edge_docs, edge_labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in toxicity_scores(edge_docs, edge_labels.limit(0)).collect()} == {0.0}


def test_decoding_gives_the_texts_back(spark, edge_docs):
    got = decode_documents(encode_documents(edge_docs, MODEL), MODEL).collect()
    want = [((t or "").replace("▁", " ")) for _, t, *_ in EDGE_ROWS]
    assert sorted(r["text"] for r in got) == sorted(want)


def test_pipeline_stages_keep_columns_and_edge_rows(spark, edge_docs, edge_labels, workdir):
    edge_labels.write.parquet(str(workdir / "labels.parquet"))
    docs = edge_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(workdir))
        assert out.columns == edge_docs.columns
        path = str(workdir / stage.__name__)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, str(workdir)).collect()) == docs.count()


def test_pipeline_stages_on_no_rows(spark, no_docs, edge_labels, workdir):
    edge_labels.write.parquet(str(workdir / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(workdir)).collect() == []


def test_near_copies_leave_one_document_of_each_group(spark):
    rows = [(k, " ".join(f"w{i}" for i in range(400))) for k in (5, 3, 9)] + [(7, "something else entirely, unlike the others")]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7]
