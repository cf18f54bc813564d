"""Joins with tables that may be small, and on keys that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.session import work_table

#: Keys (of some 20 bytes each) that are looked up by a broadcast; more are joined by a shuffle.
LOOK_UP = 250_000
#: Rows that one task may get on a join key; and the share of all rows that makes a key hot, so at most 1 / HOT are.
PLAIN, HOT = 1_000_000, 1 / 1_000


def small(keys: DataFrame) -> DataFrame:
    """keys, a written table, to be broadcast if it has at most LOOK_UP rows; else the other side is shuffled to it."""
    return F.broadcast(keys) if keys.count() <= LOOK_UP else keys


def join_hot(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", plain: int = PLAIN) -> DataFrame:
    """rows joined with table, in which key is unique; a key of rows may hold any share of them.

    Rows of hot keys stay where they are: what the table has for them, at most 1 / HOT rows, is broadcast.
    The others are shuffled, each key with less than HOT of all rows. Of at most `plain` rows (a written
    table, so the count is cheap) a task can take all, and a plain join serves. Null keys match nothing.
    """
    n = rows.count()
    if n <= plain:
        return rows.join(table, key, how)
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = work_table(counts.filter(F.col("_n") > n * HOT).select(key), "hot")
    found = work_table(table.join(F.broadcast(hot), key, "left_semi"), "hot_rows")
    heavy = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(found), key, how)
    return heavy.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how))
