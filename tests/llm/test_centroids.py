import hashlib
import math
import random

import pytest

from carelake.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, point string"


def brute(rows, k, rounds, n):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and len(e) == n and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [p for _, p in order[:k]]

    def near(p):
        return min((sum((x - y) ** 2 for x, y in zip(p, q, strict=True)), j) for j, q in enumerate(c))

    for _ in range(rounds):
        groups = {}
        for _, p in kept:
            groups.setdefault(near(p)[1], []).append(p)
        for j, members in groups.items():
            c[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out = [(i, near(p)[1], near(p)[0]) for i, p in kept]
    each = {}
    for _, j, d in out:
        each[j] = each.get(j, 0) + d
    return sorted(((i, j, d, each[j], sum(each.values())) for i, j, d in out), key=repr), c


def vectors(seed, count, n):
    r = random.Random(seed)
    # few distinct values: equal vectors and equal distances occur
    rows = [(i, [r.choice([-1.5, -0.251, -0.003, 0.0, 0.004, 0.7]) for _ in range(n)]) for i in range(count)]
    return rows + rows[:40]


@pytest.mark.parametrize(("k", "count"), [(7, 300), (40, 300), (40, 5)])
def test_equals_brute_force(spark, k, count):
    rows = vectors(k, count, 4)
    rows += [(None, [0.1, 0.2, 0.3, 0.4]), (None, None), (1, []), (2, [0.1, None, 0.2, 0.3]), (3, [float("nan")] * 4), (4, [float("inf")] + [0.0] * 3), (5, [0.1] * 5)]
    single = [(i, e and [x if x is None else spark_float(x) for x in e]) for i, e in rows]
    df = spark.createDataFrame([(i, e, "own", "own", "own") for i, e in rows], SCHEMA).repartition(5)
    out, found = centroids.clustered(df, k=k, rounds=3, components=4)
    want, c = brute(single, k, 3, 4)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert found == c


def spark_float(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5], "", "", ""), (2, None, "", "", "")], SCHEMA)
    out, found = centroids.clustered(df)
    assert out.count() == 0 and found == []
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]


def test_huge_components_are_held(spark):
    df = spark.createDataFrame([(1, [3e38, -3e38], "", "", ""), (2, [-3e38, 3e38], "", "", "")], SCHEMA)
    out, _ = centroids.clustered(df, k=1, rounds=0, components=2)
    assert {r["distance"] for r in out.collect()} == {0, 2 * (2 * centroids.LARGEST) ** 2}


def test_runs_in_the_jvm(spark):
    points = centroids.scaled(spark.createDataFrame([(1, [0.5, 1.0], "", "", "")], SCHEMA), 2)
    plan = points.select(centroids.nearest([[1, 2], [3, 4]]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
