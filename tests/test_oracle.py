"""Every registered query against its SQL counterpart in a second engine."""

import pytest
from compare import differences, duckdb_over

from tidemark.registry.oracle import ORACLE
from tidemark.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) is None
