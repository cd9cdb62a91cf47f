"""Shapes the charts are drawn from: pivots, shares, box-plot numbers and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def cells(
    long: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], cell: Column, fill=None
) -> DataFrame:
    """Pivot of a table that has one row per cell. `values` names the columns, so the schema does not
    depend on the data and no job is spent on finding them."""
    wide = long.groupBy(*rows).pivot(column, list(values)).agg(F.first(cell, ignorenulls=True))
    return wide if fill is None else wide.fillna(fill, list(values))


def with_share(totals: DataFrame, amount: str, into: str = "share") -> DataFrame:
    """Part of the grand total, which is a one-row aggregate of its own: no task holds all rows."""
    grand = totals.agg(F.sum(amount)).scalar()
    return totals.withColumn(into, F.try_divide(F.col(amount), grand))


def top(rows: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The `k` rows with the largest `by`, ties in the order of the other columns."""
    return rows.orderBy(F.desc_nulls_last(by), *(F.asc_nulls_first(c) for c in ties)).limit(k)


def box_numbers(values: DataFrame, column: str) -> DataFrame:
    """Quartiles, whisker ends (the outermost values within 1.5 interquartile ranges) and the number
    of outliers of a column. Meant for distinct values of a small domain, such as ages: the exact
    percentile keeps one counter per distinct value.
    """
    quarters = F.array(*map(F.lit, (0.25, 0.5, 0.75)))
    found = values.agg(F.percentile(column, quarters)).scalar()
    ranked = values.select(F.col(column).alias("v"), found.alias("q"))
    at = [F.col("q")[i] for i in range(3)]
    reach = (at[2] - at[0]) * 1.5
    judged = ranked.select(
        "v",
        *(a.alias(name) for a, name in zip(at, ("q1", "median", "q3"))),
        F.col("v").between(at[0] - reach, at[2] + reach).alias("inside"),
    )
    inside = F.when(F.col("inside"), F.col("v"))
    return judged.agg(
        F.min("v").alias("lowest"),
        F.min(inside).alias("whisker_low"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.max(inside).alias("whisker_high"),
        F.max("v").alias("highest"),
        F.count_if(~F.col("inside")).alias("outliers"),
    )
