"""Every registered query against its SQL, on the driver's tables."""

from __future__ import annotations

import os
import re

import pytest
from oracle_check import compare, duck

import __spark_entry__ as e
from quoteloom.plans.acceptance import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = e.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan|BatchScan|Scan JDBC", plan), "the optimizer left nothing to read"
    assert compare(df, con, e.oracle_sql()[name]) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = e.entry(spark), e.entry(spark)
    assert first.schema == second.schema
    assert first.count() == second.count() > 0
