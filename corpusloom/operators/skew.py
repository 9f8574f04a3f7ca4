"""Joins of rows to one value a key, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key from which its group row is broadcast instead of its rows being gathered by key.
HOT_ROWS = 100_000
#: There are at most so many keys of that size, whatever the number of rows.
HOT_KEYS = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str = "n", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row a key and the key's number of rows in ``count``.

    Keys of many rows are joined where their rows lie: their group rows are broadcast, at most ``HOT_KEYS`` of them, as no
    more keys can each hold that part of all rows. The rows of other keys are shuffled. Both frames are read twice and
    should be tables. Null keys join nothing.
    """
    total = groups.select(F.sum(count)).first()[0] or 0
    least = max(hot_rows, -(-total // HOT_KEYS))
    hot, cold = groups.where(F.col(count) >= least), groups.where(F.col(count) < least)
    shuffled = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key) if total >= least else rows.join(cold, key)
    return shuffled.unionByName(rows.join(F.broadcast(hot), key)) if total >= least else shuffled
