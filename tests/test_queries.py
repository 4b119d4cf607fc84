"""Every query of the core runs on the smallest tables and gives what its SQL gives."""

import os

import pytest

from gradelex.plans import registry
from tests import parity

DATA = os.environ.get("GRADELEX_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return parity.connect(DATA)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, con, name):
    parity.same(spark, DATA, con, registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 56
    assert set(e.oracle_sql()) <= set(e.queries())
