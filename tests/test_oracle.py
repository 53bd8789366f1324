"""Every query with an SQL twin gives the same rows, to the last bit."""

import pytest
from compare import check, connect

from tillsight.plans.oracle import oracle
from tillsight.plans.queries import registry

SQL = oracle()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(registry())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, db, sf, name):
    rows, problem, _ = check(spark, db, name, registry()[name], SQL[name], sf)
    assert problem is None
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(registry()) - set(SQL)))
def test_runs(spark, sf, name):
    df = registry()[name](spark, sf)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 2704


# Row counts stated for the smallest tables.
def test_stage_sizes(t):
    assert t.raw.count() == 6095
    assert t.purchases.count() == 4279
    assert t.clean.count() == 3734
    assert (t.fences.quantity.upper, t.fences.price.upper) == (78.0, 2123.0)
    assert t.monthly.count() == 3304
    assert t.features.count() == 2704
    assert (t.train.count(), t.test.count()) == (2427, 73)
