import os

import pytest

from corpusloom.llm import queries
from tests import compare


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, name):
    if not os.path.isdir(compare.ROOT):
        pytest.skip("no test tables")
    if name in queries.SQL:
        compare.check(spark, queries.QUERIES[name], queries.SQL[name])
    else:
        assert queries.QUERIES[name](spark, compare.ROOT).count() > 0
