"""Joining rows that may have hot keys with a table of one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may hold.
HOT_ROWS = 1000
#: Keys that are broadcast at most.
HOT_KEYS = 100_000


def join_counted(rows: DataFrame, table: DataFrame, key: str | list[str], total: int, n: str = "n") -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per ``key`` and in ``n`` the key's number of ``rows``.

    ``total`` is at least the number of rows with a key of the table. Keys with over ``HOT_ROWS`` of them, and no more than
    ``HOT_KEYS`` keys, are broadcast, so that their rows stay where they are; the rest is shuffled.
    """
    keys = [key] if isinstance(key, str) else key
    values = [c for c in table.columns if c not in (*keys, n)]
    if total <= HOT_ROWS:
        return rows.join(table.drop(n), key)
    many = F.col(n) > max(HOT_ROWS, total // HOT_KEYS)
    hot = table.filter(many).select(*keys, F.struct(F.lit(True).alias("hot"), *values).alias("found"))
    marked = rows.join(F.broadcast(hot), key, "left")
    here = marked.filter("found is not null").select(*rows.columns, *[f"found.{c}" for c in values])
    rest = marked.filter("found is null").drop("found").join(table.filter(~many).drop(n), key)
    return here.unionByName(rest.select(*here.columns))
