"""The stages of the pipeline, one after the other, against plain versions on the smallest tables."""

from collections import Counter

import brute
import public_tokenizers

import corpus_pipeline
from tidemark.llm.line_quality import line_quality
from tidemark.session import written

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "benchmark_passages", "source_weights", "token_ids"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]

    def of(df):
        return [(r.doc_id, r.text, r.source) for r in df.collect()]

    accepted = {r.doc_id for r in line_quality(docs, labels).filter("predicted = 1").collect()}
    first = written(stages["quality"](spark, docs, FOLDER), "first")
    assert first.columns == docs.columns and {d for d, *_ in of(first)} == accepted

    second = written(stages["near_copies"](spark, first, FOLDER), "second")
    groups = brute.near_duplicates([(d, x) for d, x, _ in of(first)])
    assert second.columns == docs.columns and {d for d, *_ in of(second)} == {d for d, (_, c) in groups.items() if c == d}

    third = written(stages["benchmark_passages"](spark, second, FOLDER), "third")
    bad = brute.benchmark_hits([(d, x) for d, x, _ in of(second)], items)
    assert third.columns == docs.columns and {d for d, *_ in of(third)} == {d for d, *_ in of(second)} - bad

    fourth = written(stages["source_weights"](spark, third, FOLDER), "fourth")
    copies = brute.mixed_copies(of(third))
    assert fourth.columns == docs.columns and Counter(d for d, *_ in of(fourth)) == {d: n for d, n in copies.items() if n}

    last = stages["token_ids"](spark, fourth, FOLDER)
    expected = brute.token_files([(d, x) for d, x, _ in of(fourth)], public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(tuple(r) for r in last.collect()) == expected


def test_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), name)
    assert docs.count() == 0
