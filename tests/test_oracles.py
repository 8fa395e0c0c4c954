"""Every registered query against its DuckDB twin."""

import os

import pytest

from tapeloom.workload.oracles import oracle_sql
from tapeloom.workload.queries import queries
from tests.compare import connect, differences

DIRECTORY = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_twin(spark, con, name):
    assert differences(queries()[name](spark, DIRECTORY), con, oracle_sql()[name]) == []
