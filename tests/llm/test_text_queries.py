"""The queries of the text subpackage against their SQL or plain versions, on the smallest tables."""

import brute
import pytest
from run_one import against_sql

from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def texts(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert against_sql(spark, FOLDER, name) is None


def test_near_duplicates(spark):
    expected = brute.near_duplicates(texts(spark))
    rows = QUERIES["op10_near_duplicates"](spark, FOLDER).collect()
    assert len(rows) == len(expected)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_token_files(spark):
    import public_tokenizers

    expected = brute.token_files(texts(spark), public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(tuple(r) for r in QUERIES["op4_token_files"](spark, FOLDER).collect()) == expected


def test_language_model(spark):
    expected = brute.base_scores(texts(spark))
    rows = QUERIES["op3_language_model"](spark, FOLDER).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == {d: x[:4] for d, x in expected.items()}
    assert all(r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9) for r in rows)
    new = [r for r in rows if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)


def test_suffix_dedup(spark):
    import hashlib

    expected = {d: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for d, x in brute.removed(texts(spark)).items()}
    rows = QUERIES["op7_suffix_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected
