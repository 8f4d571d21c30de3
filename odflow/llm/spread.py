"""Joins of a large table with one row per key, where a few keys may hold much of the large side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one in ``HOT_SHARE`` of all rows, so at most ``HOT_SHARE`` keys are hot.
HOT_SHARE = 4096


def join_spread(rows: DataFrame, table: DataFrame, key: str, count_col: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key, ``count_col`` = rows that have it), without ``count_col``.

    Rows of hot keys stay where they are and meet the at most ``HOT_SHARE`` hot rows of ``table`` by broadcast, the others
    are shuffled. Both sides should be stored tables, as each is read twice.
    """
    hot = table.filter(F.col(count_col) * HOT_SHARE > total).drop(count_col)
    cold = table.filter(F.col(count_col) * HOT_SHARE <= total).drop(count_col)
    keys = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(keys, key, "left_anti").join(cold, key))
