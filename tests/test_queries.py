"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from acervo.workloads import all_oracles, all_queries
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, all_queries()[name], all_oracles()[name]) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(all_queries()) <= set(__spark_entry__.queries())
    assert set(all_oracles()) <= set(__spark_entry__.oracle_sql())
