"""Every query against its SQL."""

import pytest

from gridloom.plans.catalogue import ORACLE_SQL, QUERIES

from .conftest import agrees


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    agrees(spark, duck, QUERIES[name], ORACLE_SQL[name])


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
