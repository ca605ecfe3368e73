"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare, duck
from pairloom.plans import catalogue

SF = "/root/testdata/sf0.001"
# nothing to find in the smallest tables; the larger ones are checked by compare.py
MAY_BE_EMPTY = {"folder_first_positive_skips", "validate_unused"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)
    assert set(catalogue.QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["split", "image_id", "image_b64"]


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert verdict is None or (verdict == "no rows" and name in MAY_BE_EMPTY)
