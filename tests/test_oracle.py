"""Every registered query against its SQL on the small fixture."""

import os

import pytest

from tidemart.checks.compare import compare, connect
from tidemart.checks.oracle import oracle_texts
from tidemart.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TEXTS = oracle_texts()
# The smallest fixture has no order lines or payments on the days of these.
EMPTY = {"fact_order_line_daily", "fact_payment_line_daily"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(TEXTS) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, QUERIES[name], TEXTS[name], FOLDER)
    assert problem is None or name in EMPTY and problem == "both results are empty"


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
