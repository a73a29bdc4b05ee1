"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

from threadmill.llm import entries

from ..oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_query(spark, name):
    compare(entries.QUERIES[name](spark, SF), connect(SF), entries.ORACLE_SQL[name])
