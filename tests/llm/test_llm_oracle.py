"""Queries of the package that SQL can express, beside their SQL at the smallest scale."""

import pytest

from hazeline.llm.queries import ORACLE
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    verdict = compare(spark, con, SF, name)
    assert verdict.startswith("ok"), verdict
