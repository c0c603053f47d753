"""The corpus pipeline: quality, near copies, benchmark passages, source weights, token files.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents. All stages but the last return the columns of their input. A stage sees nulls, empty texts,
repeated rows and further columns as its operator's module says; empty documents give an empty result.
"""

from __future__ import annotations

import public_tokenizers

from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.line_quality import drop_low_quality
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.token_files import token_files
from tidemark.session import configure, written


def quality(spark, docs, sf_dir):
    """Documents that the line classifier accepts."""
    configure(spark)
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark, docs, sf_dir):
    """One document of every group of near duplicates: the one with the smallest id."""
    configure(spark)
    return drop_near_duplicates(docs)


def benchmark_passages(spark, docs, sf_dir):
    """Documents that hold no window of a benchmark item."""
    configure(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_weights(spark, docs, sf_dir):
    """Every document as often as the mix takes it."""
    configure(spark)
    return mix(docs)


def token_ids(spark, docs, sf_dir):
    """Token files of what is left, read back: (doc_id, start, n_tokens, ids_crc32)."""
    configure(spark)
    return token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("source_weights", source_weights),
    ("token_ids", token_ids),
]

#: SQL can neither fit the line classifier nor encode token ids; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of the folder."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
