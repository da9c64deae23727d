import os

import pytest

import __spark_entry__ as entry
from checks import queries as checks_queries
from checks.verify import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = checks_queries.QUERIES, checks_queries.ORACLES

# Steps of longer queries that are tested below; CHECK_ALL=1 (or checks.verify) runs them on their own.
STEPS = {
    "fuzzy_year_pairs", "duplicate_titles", "duplicate_title_count", "cleaned_records", "journal_metrics_issn_year",
    "doc_types_by_year", "dedup_distribution",
}
TESTED = sorted(ORACLES if os.environ.get("CHECK_ALL") else set(ORACLES) - STEPS)


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    # The weighted ratio counts common subsequences, which SQL has no function for: test_wratio.py is its brute force.
    assert set(checks_queries.QUERIES) - set(checks_queries.ORACLES) == {"fuzzy_wratio"}


@pytest.mark.parametrize("name", TESTED)
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"Source", "Year", "records"}
