"""Every registered query against its SQL, on the smallest tables."""

import os
import re

import pytest
from compare import difference, duck

import __spark_entry__ as entry_points
from tidemark.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TIDEMARK_TEST_DIR", "/root/testdata/sf0.001")
# The queries of the text subpackage have tests of their own in tests/llm.

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert difference(spark, connection, FOLDER, QUERIES[name], ORACLES.get(name)) is None


# Queries that group or order per key, once more with every group treated as a large one.
SPLIT = [
    "row_number_partition",
    "union_feeds",
    "overlap_check",
    "tt_all_versions",
    "tt_update",
    "tt_as_of",
    "json_nested_unnest",
    "json_array_elements",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_split_groups(spark, connection, setting, name):
    setting("tidemark.hotGroupRows", 5)
    setting("tidemark.partRows", 5)
    assert difference(spark, connection, FOLDER, QUERIES[name], ORACLES.get(name)) is None


# Every other query on nested groups: scalars don't depend on the limit; arrays are equal once their parts are put together.
SCALARS = ["array_length", "json_path_get", "json_path_get_text", "json_contains_array", "json_contains_two", "json_nested_unnest"]
ARRAYS = [
    "join_left_preagg",
    "join_inner_preagg",
    "agg_array_scalar",
    "agg_array_rows",
    "agg_sum_array_len",
    "agg_rows_in_object",
    "albums_with_track_names",
    "documents_per_actor",
]


@pytest.mark.parametrize("limit", [1, 5])
@pytest.mark.parametrize("name", SCALARS)
def test_scalars_of_cut_groups(spark, connection, setting, name, limit):
    setting("tidemark.partRows", limit)
    assert difference(spark, connection, FOLDER, QUERIES[name], ORACLES.get(name)) is None


def put_together(df):
    """Rows with the arrays of all parts in one."""
    whole = {}
    for row in sorted(map(lambda r: r.asDict(), df.collect()), key=lambda r: r["part_no"]):
        text = next(c for c in ("order_keys", "order_rows", "doc", "names") if c in row)
        key = tuple(sorted((c, v) for c, v in row.items() if c not in (text, "part_no")))
        items = re.findall(r"\{[^{}]*\}|\w+", (row[text] or "").split("[", 1)[-1])
        whole.setdefault(key, []).extend(items)
    return whole


@pytest.mark.parametrize("limit", [1, 5])
@pytest.mark.parametrize("name", ARRAYS)
def test_arrays_of_cut_groups(spark, setting, name, limit):
    expected = put_together(QUERIES[name](spark, FOLDER))
    setting("tidemark.partRows", limit)
    assert put_together(QUERIES[name](spark, FOLDER)) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
