"""Clustering against plain loops over whole vectors."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from eavista.llm import catalog, centroids
from tests.compare import SF_DIR

COLUMNS = "vec_id long, embedding array<double>"


def by_force(table, k=16, rounds=3, dimensions=64):
    kept = []
    for vec_id, x in table:
        if x is not None and len(x) == dimensions and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(64 * v) for v in x]))
    key = lambda row: (hashlib.sha256(f"1:{'null' if row[0] is None else row[0]}".encode()).hexdigest(), row[1])
    middle = [x for _, x in sorted(kept, key=key)[:k]]
    for step in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(middle)) for _, x in kept]
        if step < rounds:
            for i in range(len(middle)):
                own = [x for (_, x), (_, at) in zip(kept, found) if at == i]
                middle[i] = [sum(column) // len(own) for column in zip(*own)] if own else middle[i]
    inertia = [sum(d for d, at in found if at == i) for i in range(len(middle))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(
        (str(vec_id), at, d, inertia[at], sum(inertia), digests[at]) for (vec_id, _), (d, at) in zip(kept, found)
    )


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_registered_query_equals_plain_loops(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert rows_of(catalog.queries()["op12_centroid_clusters"](spark, SF_DIR)) == by_force(table)


def odd_vectors():
    rng = random.Random(4)
    near = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(40)]
    rows = [(i, near[i % 40]) for i in range(90)]  # ties and copies
    rows += [(7, near[3]), (7, near[5]), (None, near[0]), (None, near[1]), (100, None), (101, []), (102, [0.0] * 63), (103, [0.0] * 65)]
    rows += [(104, [None] + [0.0] * 63), (105, [float("nan")] + [0.0] * 63), (106, [float("-inf")] + [0.0] * 63)]
    rows += [(107, [3e7] + [0.0] * 63), (108, [-3e7] * 2 + [0.0] * 62)]  # squares need more than a double holds exactly
    return rows


def test_odd_vectors(spark):
    df = spark.createDataFrame(odd_vectors(), COLUMNS)
    assert rows_of(centroids.cluster(df)) == by_force(odd_vectors())
    clash = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("cluster", "x", "shard", "ids", "kind", "group_id", "distance"))])
    assert rows_of(centroids.cluster(clash)) == by_force(odd_vectors())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(40)]])
def test_few_vectors(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    assert rows_of(centroids.cluster(df)) == by_force(rows)
    assert centroids.cluster(df).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_other_shapes(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 2) for _ in range(70)]) for i in range(300)]
    found = rows_of(centroids.cluster(spark.createDataFrame(rows, COLUMNS), k=5, rounds=6, dimensions=70))
    assert found == by_force(rows, 5, 6, 70)


def test_huge_components_do_not_fail(spark):
    rows = [(i, [1e300 * (-1) ** i] + [float(i)] * 63) for i in range(20)]
    found = centroids.cluster(spark.createDataFrame(rows, COLUMNS)).collect()
    assert len(found) == 20 and all(0 <= r.distance <= r.cluster_inertia <= r.inertia for r in found)


def test_buckets_stay_where_they_are(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    vectors = df.select("vec_id", centroids.components(df["embedding"], 64, 64).alias("x"))
    start = centroids.first_centroids(vectors, 16, 1)
    tiled = centroids.bucketed(centroids.tiles(vectors, 64), "group_id", int(spark.conf.get("spark.sql.shuffle.partitions")), "tiles")
    joined = tiled.join(centroids.assigned(tiled, start), "group_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
