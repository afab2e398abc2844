"""Clusters against plain Python integers."""

import hashlib
import math

import pytest
from pyspark.errors import PySparkException

from sensormart.llm.clusters import cluster_vectors, moved_centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int, distance int"


def brute(rows, clusters=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * x) for x in e])
        for i, e, *_ in rows
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)
    ]
    digest = {i: hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "~" for i, _ in kept}
    centroids = [v for i, v in sorted(kept, key=lambda r: (digest[r[0]], r[1]))[:clusters]]

    def best(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        centroids = [
            [sum(column) // len(groups[n]) for column in zip(*groups[n])] if n in groups else c
            for n, c in enumerate(centroids)
        ]
    found = [(i, *best(v)) for i, v in kept]
    total = {n: sum(d for _, d, m in found if m == n) for n in range(clusters)}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, total[n], sum(total.values()), names[n]) for i, d, n in found), key=str)


def rows_of(rng, n, spread=1.0):
    return [(i, [rng.uniform(-spread, spread) for _ in range(64)], "x", 1, 2) for i in range(n)]


def got(table, **options):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, cluster_vectors(table, **options).select(*columns).collect()), key=str)


def test_odd_rows(spark):
    import random

    rows = rows_of(random.Random(1), 120)
    rows += [(200, None), (201, [0.5] * 63), (202, [0.5] * 65), (203, [math.nan] + [0.0] * 63)]
    rows += [(204, [None] + [0.0] * 63), (205, [math.inf] * 64), (206, [-math.inf] * 64), (207, [])]
    rows += [(None, [0.25] * 64), (None, [-0.25] * 64), (5, rows[5][1]), (5, rows[6][1])]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # copies: a third of all
    rows = [(*r, "x", 1, 2)[:5] for r in rows]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ties_empty_clusters_and_few_vectors(spark):
    one = [0.1] * 64
    rows = [(i, one, "x", 1, 2) for i in range(10)] + [(50, [-0.3001] * 64, "x", 1, 2)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    few = rows[8:]
    assert got(spark.createDataFrame(few, SCHEMA)) == brute(few)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_an_empty_cluster_keeps_its_centroid(spark):
    kept = spark.createDataFrame([(1, [5, 5]), (2, [6, 6])], "vec_id long, v array<long>")
    assert moved_centroids(kept, [[5, 6], [900, 900]]) == [[5, 5], [900, 900]]


def test_downwards_for_negative_sums(spark):
    kept = spark.createDataFrame([(1, [-1, 1]), (2, [-2, 2])], "vec_id long, v array<long>")
    assert moved_centroids(kept, [[0, 0]]) == [[-2, 1]]


def test_too_large_for_exact_sums(spark):
    table = spark.createDataFrame([(1, [1e300] * 64, "x", 1, 2)], SCHEMA)
    with pytest.raises(PySparkException, match="too large"):
        cluster_vectors(table).collect()


def test_plan_is_native_and_combines_before_the_shuffle(spark):
    table = spark.createDataFrame(rows_of(__import__("random").Random(2), 20), SCHEMA)
    plan = cluster_vectors(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
