"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import common


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node with an edge, other than the roots: root is the least node of its component.

    `edges` has long columns a and b; direction, loops and repeats do not matter. Each round is written
    to the shared folder, and the driver sees a count and a checksum of it.
    """
    now = common.staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sign == seen or not sign[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sign
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", "m").union(small.select("b", "m")).toDF("a", "b")
        now = common.staged(small.filter("a <> b").distinct())


def stars(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of the distinct ids the least id of its component; a and b are places of the edges' ends."""
    label = np.argsort(np.argsort(ids))
    while True:
        new, least = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == label).all():
            return np.sort(ids)[label]
        label = new
