"""Distinct counts and quantiles that merge: a small table of sketches per day, never a second scan.

A day's rows are sketched once, when they arrive. Counts and quantiles over any days or groups come from
merging sketches, whose size does not depend on the number of rows: `LG` gives distinct counts within about
1.04 / sqrt(2 ** LG) (0.8 % for 14), `K` quantiles whose rank is off by about 1.3 % for 200. Sketches are built by
partial aggregation, so a task hands on one for each day and group, however many values it has seen.

NULL is no value. A day or group without any value has no estimate for quantiles and 0 distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LG, K = 14, 200


def daily(
    table: DataFrame, day: Column, *keys: str, distinct: Sequence[str] = (), numbers: Sequence[str] = ()
) -> DataFrame:
    """One row per day and group: rows, a sketch of the distinct values of some columns, and one of the
    quantiles of others with their least and greatest value. New days are appended to such a table."""
    values = [F.hll_sketch_agg(F.col(c).cast("string"), LG).alias(f"{c}_distinct") for c in distinct]
    for c in numbers:
        number = F.col(c).cast("double")
        values += [
            F.kll_sketch_agg_double(number, K).alias(f"{c}_quantiles"),
            F.min(number).alias(f"{c}_lowest"),
            F.max(number).alias(f"{c}_highest"),
        ]
    return table.groupBy(day.alias("day"), *keys).agg(F.count("*").alias("rows"), *values)


def distinct_counts(sketches: DataFrame, column: str, *keys: str, into: str) -> DataFrame:
    """Estimated number of distinct values over all days of the table."""
    merged = F.hll_sketch_estimate(F.hll_union_agg(f"{column}_distinct"))
    return sketches.groupBy(*keys).agg(F.coalesce(merged, F.lit(0).cast("long")).alias(into))


def box_numbers(sketches: DataFrame, column: str, *keys: str) -> DataFrame:
    """Box-plot numbers over all days of the table: exact ends, estimated quartiles, and about how many values
    lie more than 1.5 interquartile ranges away from the box. No values, no box."""
    merged = (
        sketches.groupBy(*keys)
        .agg(
            F.kll_merge_agg_double(f"{column}_quantiles").alias("sketch"),
            F.min(f"{column}_lowest").alias("lowest"),
            F.max(f"{column}_highest").alias("highest"),
        )
        .filter("lowest is not null")
    )
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxed = merged.withColumns({n: F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for n, q in shares.items()})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    # one point in the middle of every percent
    points = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit((i + 0.5) / 100) for i in range(100))))
    outside = F.filter("points", lambda x: ~x.between(F.col("q1") - reach, F.col("q3") + reach))
    outliers = F.round(F.size(outside) / 100 * F.kll_sketch_get_n_double("sketch")).cast("long")
    return boxed.withColumn("points", points).select(*keys, "lowest", *shares, "highest", outliers.alias("outliers"))
