import pytest

from corpusloom.plans import registry
from tests import compare

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_what_its_sql_gives(spark, name):
    compare.check(spark, registry.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    import os

    if not os.path.isdir(compare.ROOT):
        pytest.skip("no test tables")
    assert registry.queries()[name](spark, compare.ROOT).count() > 0


def test_entry_runs(spark):
    import os

    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir(compare.ROOT):
        assert entry.entry(spark).count() > 0
