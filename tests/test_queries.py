"""Every query against its SQL, on the smallest tables."""

import pytest

from checks import ORACLES, QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sql):
    result = QUERIES[name](spark, SF).toPandas()
    assert len(result)
    if name in ORACLES:
        assert difference(result, sql.execute(ORACLES[name]).df()) is None


def test_entry_functions(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 20
