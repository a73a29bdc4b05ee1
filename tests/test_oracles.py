"""Every registered query of the library against its SQL."""

from __future__ import annotations

import pytest

from threadmill.plans import registry

from .oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLE_SQL:
        compare(df, con, registry.ORACLE_SQL[name])
    else:
        assert df.count() > 0
