"""Every registered query of the document engine against its SQL."""

import compare
import pytest

from quire.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    if name in catalogue.ORACLE:
        assert compare.difference(spark, con, SF, catalogue.QUERIES[name], catalogue.ORACLE[name]) is None
    else:
        assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_registry():
    assert catalogue.FLAGSHIP in catalogue.QUERIES and set(catalogue.ORACLE) <= set(catalogue.QUERIES)
