"""Centroid clustering of vectors in integers, as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormart.session import materialise

#: Components of a vector that takes part; each is scaled and rounded down.
COMPONENTS, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3
#: Scaled components must not lie beyond it: 64 squared differences then fit 64 bits, and so
#: do the sums of 2**37 vectors.
LARGEST = 1 << 26


def scaled_vector(embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a long, x as double; beyond ``LARGEST`` an error."""
    vector = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    beyond = F.exists(vector, lambda x: (x > LARGEST) | (x < -LARGEST))
    return F.when(beyond, F.raise_error(F.lit("a vector's component is too large for 64-bit sums"))).otherwise(vector)


def is_usable(embedding: str = "embedding", components: int = COMPONENTS) -> Column:
    """Exactly so many components, none null or non-finite; false for a null vector."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(embedding) == components) & finite, F.lit(False))


def squared_distance(vector: str, centroid: list[int]) -> Column:
    """The squared distance to a centroid, which is a literal array."""
    literal = F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")
    apart = F.zip_with(vector, literal, lambda x, c: x - c)
    return F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: total + d * d)


def nearest(vector: str, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid; of equally near ones the smaller number."""
    found = [
        F.struct(squared_distance(vector, c).alias("distance"), F.lit(number).alias("cluster"))
        for number, c in enumerate(centroids)
    ]
    # The least of a single struct is itself, and array_min takes any number of them.
    return F.array_min(F.array(*found))


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids; null ids last, equal ids by components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.select(digest.alias("digest"), "v").orderBy(F.asc_nulls_last("digest"), "v").limit(clusters)
    return [list(row.v) for row in rows.collect()]


def moved_centroids(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: assign, then the floor of each component's mean; empty clusters stay.

    The sums are combined in the map tasks: one row a task and cluster is shuffled,
    and as many rows as there are clusters reach the driver.
    """
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    assigned = kept.select(nearest("v", centroids)["cluster"].alias("cluster"), "v")
    moved = list(centroids)
    for row in assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        # Exact, and downwards for negative sums too.
        moved[row.cluster] = [row[f"s{i}"] // row.n for i in range(len(sums))]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """Lloyd's rounds from fixed starting vectors, exact in 64-bit integers.

    Vectors with another number of components, or with null or non-finite ones,
    are left out. Every other row is a vector of its own, repeated rows and null
    ids included; with fewer vectors than ``clusters`` there are fewer centroids,
    and an empty table gives no rows. A component beyond ``LARGEST`` after scaling
    is an error and never a wrapped sum. Other columns are not read.

    Scaled vectors are written once; a round reads them and returns one row of
    sums a cluster. Rounds end early only where no centroid moves any more, when
    all further ones would change nothing.

    Returns vec_id, cluster, distance (squared, to the final centroid),
    cluster_inertia and inertia (distance summed over cluster and table),
    centroid_sha256 (of the final centroid's components, joined by commas).
    """
    usable = vectors.select("vec_id", "embedding").filter(is_usable("embedding", components))
    kept = usable.select("vec_id", scaled_vector("embedding", components, scale).alias("v"))
    kept = materialise(kept, "scaled-vectors")
    centroids = first_centroids(kept, clusters, seed)
    if not centroids:
        return kept.select(
            "vec_id",
            F.lit(0).alias("cluster"),
            *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    for _ in range(rounds):
        moved = moved_centroids(kept, centroids)
        if moved == centroids:
            break
        centroids = moved
    assigned = kept.select("vec_id", nearest("v", centroids).alias("best")).select("vec_id", "best.cluster", "best.distance")
    assigned = materialise(assigned, "clusters")
    inertia = [0] * len(centroids)
    for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect():
        inertia[row.cluster] = row.total
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
