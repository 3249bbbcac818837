"""Every registered query against its DuckDB oracle (small scale), and the
rows-only queries for a non-empty, stable schema."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

# The text operators' queries are tested with them, in tests/llm.
ORACLES = E.ORACLES
WITH_ORACLE = sorted(k for k in E.QUERIES if k in ORACLES)
ROWS_ONLY = sorted(k for k in E.QUERIES if k not in ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", WITH_ORACLE)
def test_query_matches_oracle(spark, con, key):
    r = compare(E.QUERIES[key](spark, SF_SMALL), ORACLES[key], con)
    assert r["ok"], r


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_query_runs(spark, key):
    df = E.QUERIES[key](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["reviewerID", "number_products_rated", "avg_ratings",
                          "reviewing_since", "helpful_votes", "total_votes"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_iterative():
    # Fits of word vectors and deep trees have no oracle.
    assert set(ROWS_ONLY) <= {"word_synonyms", "word_spectral_synonyms", "tree_rmse", "tree_depth_sweep", "word_document", "tree_sweep_document"}
