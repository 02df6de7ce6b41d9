"""Queries that SQL can express, against it, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from landsync.llm import catalog
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, name):
    assert compare(name, entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_every_operator_has_one_query():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
