"""Sketches of days, merged."""

import random

from pyspark.sql import functions as F

from carelake.operators import sketches


def test_merged_days_are_close_to_the_rows(spark, tmp_path):
    r = random.Random(1)
    rows = [(d, r.choice("ab"), f"p{r.randrange(4000)}" if r.random() > 0.05 else None, r.expovariate(0.01) if r.random() > 0.1 else None) for d in range(20) for _ in range(1500)]
    df = spark.createDataFrame(rows, "d int, g string, who string, x double").repartition(7)
    path = str(tmp_path / "sketches")
    # days come one after the other
    for half in ("d < 12", "d >= 12"):
        sketches.daily(df.filter(half), F.col("d"), "g", distinct=["who"], numbers=["x"]).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    assert kept.count() == 40
    for row in sketches.distinct_counts(kept, "who", "g", into="n").collect():
        exact = len({w for _, g, w, _ in rows if g == row.g and w})
        assert abs(row.n - exact) <= 0.03 * exact
    assert abs(sketches.distinct_counts(kept, "who", into="n").first().n - 4000) < 120
    for row in sketches.box_numbers(kept, "x", "g").collect():
        values = sorted(x for _, g, _, x in rows if g == row.g and x is not None)
        assert (row.lowest, row.highest) == (values[0], values[-1])
        for q, v in ((0.25, row.q1), (0.5, row.median), (0.75, row.q3)):
            assert abs(sum(x <= v for x in values) / len(values) - q) < 0.03
        reach = 1.5 * (row.q3 - row.q1)
        outside = sum(not row.q1 - reach <= x <= row.q3 + reach for x in values)
        assert abs(row.outliers - outside) < 0.03 * len(values)


def test_no_values(spark):
    df = spark.createDataFrame([(1, "a", None, None), (2, "b", "p", 2.0)], "d int, g string, who string, x double")
    kept = sketches.daily(df, F.col("d"), "g", distinct=["who"], numbers=["x"])
    assert {r.g: r.n for r in sketches.distinct_counts(kept, "who", "g", into="n").collect()} == {"a": 0, "b": 1}
    assert [tuple(r) for r in sketches.box_numbers(kept, "x", "g").collect()] == [("b", 2.0, 2.0, 2.0, 2.0, 2.0, 0)]
    empty = sketches.daily(df.limit(0), F.col("d"), distinct=["who"], numbers=["x"])
    assert empty.count() == 0
