"""Every named query against its SQL (ORACLE_SF sets the scale, default 0.001)."""

import os

import pytest

from tests import oracle
from tillroll.plans import PLANS

SF_DIR = f"{oracle.DATA}/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, p in PLANS.items() if p.sql])
def test_matches_sql(spark, con, name):
    assert oracle.compare(PLANS[name](spark, SF_DIR), con, PLANS[name].sql) == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == [
        "shopper", "week", "coupon", "product", "discount", "e_revenue",
    ]
    assert set(entry.oracle_sql()) <= set(entry.queries())
