import os

import pytest

from gradelex.llm import queries
from tests import parity

DATA = os.environ.get("GRADELEX_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    parity.same(spark, DATA, parity.connect(DATA), queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
