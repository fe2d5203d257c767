"""Every registered query against its SQL counterpart on the smallest data set."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from tests.oracle_check import compare, connect

SF_DIR = entry_point.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, db, name):
    if name not in entry_point.oracle_sql():
        assert entry_point.queries()[name](spark, SF_DIR).count() > 0
        return
    assert compare(spark, db, SF_DIR, name) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_counterpart_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
