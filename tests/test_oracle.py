"""Every registered query beside its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry
from hazeline.queries import ORACLE, REGISTRY
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    verdict = compare(spark, con, SF, name)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(ORACLE) == set(REGISTRY)


def test_entry(spark):
    assert entry(spark).count() > 0
