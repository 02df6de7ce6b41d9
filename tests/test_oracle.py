"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from landsync import catalog
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    sql = entry.oracle_sql()[name]
    assert compare(name, entry.queries()[name](spark, SF), con, sql) is None


def test_compare_sees_differences(spark, con):
    run, sql = entry.queries()["agg5_pending_count"], entry.oracle_sql()["agg5_pending_count"]
    assert compare("x", run(spark, SF), con, sql.replace("count(*)", "count(*) + 1"))


def test_entry(spark):
    assert {r.status for r in entry.entry(spark).collect()} == {
        "new", "updated", "unchanged", "conflict"}


def test_every_operator_has_a_query():
    wanted = [f"{kind}{i}" for kind, n in (
        ("src", 8), ("snk", 3), ("prj", 12), ("flt", 9), ("jon", 1), ("mrg", 4), ("ant", 1),
        ("agg", 9), ("dup", 5), ("lim", 1), ("set", 3), ("txt", 20), ("jsn", 2), ("dat", 1),
        ("str", 3), ("ext", 1)) for i in range(1, n + 1)]
    names = catalog.QUERIES
    missing = [w for w in wanted if not any(n.startswith(f"{w}_") for n in names)]
    assert missing == []
    assert set(catalog.ORACLES) == set(names) <= set(entry.queries())
