"""Centroid clustering on integers, in Spark's own expressions.

`zip_with` and `aggregate` give the squared distance of a vector to each centroid, which are literals of
the expression; the least struct of (distance, number) names the cluster, and plain column sums for each
cluster, reduced before they shuffle, move the centroids. Integers make every round exact, so results
don't depend on partitions or their order. Per round the driver sees one row of sums for each centroid.

Defined results: vectors that are NULL, have another number of components, or hold a NULL, NaN or
infinite one are left out. Components are held within 2 ** 26 times the scale's unit, so that distances
fit a long; nothing nearer to 0 changes. A NULL id counts as the empty text and equal ids start in the
order of their components; repeated rows count as often as they occur. Fewer vectors than centroids give
as many centroids as there are vectors, an empty table an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

CENTROIDS, ROUNDS, COMPONENTS, SCALE, SEED = 40, 5, 64, 256, 2
#: Largest component: 64 squares of twice it are below 2 ** 63.
LARGEST = 1 << 27


def scaled(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and `point`, the components as integers, for the vectors that are whole and finite."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = vectors.select("vec_id", "embedding").filter((F.size("embedding") == components) & ~bad)

    def held(x: Column) -> Column:
        x = F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * float(scale)))
        return F.floor(x).cast("long")

    return whole.select("vec_id", F.transform("embedding", held).alias("point"))


def first_centroids(points: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The k points whose ids have the least digests."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.point for r in points.select("point", digest.alias("digest")).orderBy("digest", "point").limit(k).collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """Struct of distance and number of the centroid nearest to `point`; of equally near ones the first."""
    literals = ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)
    return F.expr(
        f"""array_min(transform(array({literals}), (c, k) -> struct(
            aggregate(zip_with(point, c, (x, y) -> (x - y) * (x - y)), 0L, (a, b) -> a + b) AS distance, k AS cluster)))"""
    )


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of its points' mean; one without points stays."""
    sums = [F.sum(F.col("point")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    out = list(centroids)
    assigned = points.select(nearest(centroids)["cluster"].alias("cluster"), "point")
    for row in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(len(centroids[0]))]
    return out


def clustered(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance, and inertia of the cluster and of all; the centroids after the last round."""
    points = common.staged(scaled(vectors, components, scale))
    centroids = first_centroids(points, k, seed)
    if not centroids:
        none = points.select("vec_id", *(F.lit(0).cast(t).alias(c) for c, t in _RESULT))
        return none, centroids
    for _ in range(rounds):
        centroids = moved(points, centroids)
    out = points.select("vec_id", nearest(centroids).alias("near"))
    out = common.staged(out.select("vec_id", "near.cluster", "near.distance"))
    sums = dict.fromkeys(range(len(centroids)), 0)
    sums |= {r["cluster"]: r["n"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    own = F.element_at(F.array(*(F.lit(n).cast("long") for n in sums.values())), F.col("cluster") + 1)
    total = F.lit(sum(sums.values())).cast("long")
    return out.withColumns({"cluster_inertia": own, "inertia": total}), centroids


_RESULT = (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))


def digests(centroids: list[list[int]]) -> Column:
    """Digest of the components of the centroid of `cluster`."""
    each = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids]
    return F.element_at(F.array(*each, F.lit("")), F.col("cluster") + 1)
