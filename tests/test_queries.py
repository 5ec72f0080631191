"""Every registered query of the library against its SQL twin."""

from __future__ import annotations

import pytest

from tablesift.plans import catalog
from tests.compare import duck, duck_rows, spark_rows

ORACLES = catalog.oracle_sql()
#: These may be empty at the smallest scale.
MAY_BE_EMPTY = {"r_duplicate"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, con, name):
    columns, rows = spark_rows(catalog.queries()[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ORACLES)))
def test_without_sql_has_rows(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
