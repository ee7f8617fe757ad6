"""Every engine query against its SQL on the smallest tables."""

import os

import pytest

from tests.compare import assert_same, duck
from tidemark.plans import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def tables():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, tables, name):
    assert_same(queries.QUERIES[name](spark, FOLDER), tables, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() > 0


def test_merged_users_are_close(spark, tables):
    got = dict(queries.QUERIES["distinct_users_merged"](spark, FOLDER).collect())
    want = dict(tables.sql("SELECT regexp_extract(props, '\"k\": (\\d+)', 1)::BIGINT, count(DISTINCT user_id) FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1").fetchall())
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) <= max(1, 0.05 * want[k]) for k in want)
