import pytest

import __spark_entry__ as entry
from compare import connect, difference

ORACLES = entry.oracle_sql()
# The whole matrix takes minutes; ``compare.py`` runs it next to its SQL.
LONG = {"i20_training_matrix"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LONG))
def test_query_equals_sql(spark, sf, con, name):
    assert difference(entry.queries()[name](spark, sf), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert {"model", "row_label", "roc_auc"} <= set(df.columns) and df.count() > 0
