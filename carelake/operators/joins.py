"""Joins that would pair every row of a key on one side with every row on the other.

Such a join is never laid out. What a report needs of it is a count or a sum per key, so each side is
reduced first and the row counts are carried as weights: n claims joined with m encounters of a
patient are n rows of weight m. The totals are those of the full join, in linear size, and a patient
who owns a third of all rows is reduced before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def counted(rows: DataFrame, *keys: str, into: str) -> DataFrame:
    """Distinct key combinations with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias(into))


def weight(count: Column) -> Column:
    """Rows a left join makes of a left row that meets `count` right rows."""
    return F.coalesce(count, F.lit(1))


def mean_of(total: Column, count: Column) -> Column:
    """`total / count`, NULL where nothing was counted."""
    return F.try_divide(total, count)
