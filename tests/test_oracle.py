"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__
import workload
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, con, name):
    problem = difference(workload.QUERIES[name](spark, SF_DIR), con, workload.ORACLES[name])
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES)
    assert set(workload.QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 15
