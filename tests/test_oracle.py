"""Every registered query against its SQL. SF_DIR chooses the tables."""

import os

import pytest

import __spark_entry__ as entry
from corpusmill.plans.catalog import ORACLE, QUERIES
from tests.compare import compare

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_every_query_has_sql():
    """All but the counts by a BPE vocabulary, which are tested by merging (test_bpe_file)."""
    assert set(QUERIES) - set(ORACLE) == {"bpe_token_count"} and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    count, problem = compare(spark, SF, QUERIES[name], ORACLE[name])
    assert problem is None, problem


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["project_name", "tokens", "files_processed"]
    assert df.count() > 0
