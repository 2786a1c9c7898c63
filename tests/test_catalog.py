import pytest

from mnemosieve import catalog
from tests.conftest import agree


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_agrees_with_duckdb(spark, duck, name):
    agree(spark, duck, catalog.queries()[name], catalog.oracle_sql()[name])


def test_queries_without_sql():
    """These have a test against a plain version of their own."""
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"x23_word_pieces"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
