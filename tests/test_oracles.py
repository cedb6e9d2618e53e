import pytest
from check_oracles import compare

import __spark_entry__ as contract


@pytest.mark.parametrize("name", contract.queries())
def test_query_equals_its_sql(spark, data, name):
    if name in contract.oracle_sql():
        assert compare(spark, data, name) is None
    else:
        assert contract.queries()[name](spark, data).count() > 0


def test_flagship(spark, data):
    assert contract.entry(spark).count() == 32


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
