"""Every check query against its SQL oracle, over whole test tables."""

import os

import pytest

from checks.compare import differences, oracle_connection
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, oracle, name):
    assert differences(spark, oracle, SF_DIR, name) is None
