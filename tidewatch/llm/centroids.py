"""Centroid clustering of integer vectors with JVM expressions only.

Vectors become integers, so distances, sums and floors are exact and reruns
agree. The centroids of a round are a literal array in the plan:
``zip_with`` and ``aggregate`` give the squared distance to each of them,
``array_min`` over (distance, number) structs picks the nearest one, the smaller
number on ties. One column sum per component, added up before the shuffle,
moves the centroids; only k rows of sums reach the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_text, stage

DIMENSIONS, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
#: Integer components are below this, so that squared distances stay exact in 64 bits.
LARGEST = 1 << 28


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors with exactly ``dimensions`` components, none null or non-finite.

    A vector with a component of 2^28 or more after scaling is left out like one that isn't finite. A null
    vec_id stays null; repeated rows stay. Other columns are not read.
    """
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    usable = F.forall("embedding", lambda x: F.abs(x.cast("double")) < F.lit(float(LARGEST) / scale))
    # null components make forall null; NaN is greater than every number
    rows = vectors.where((F.size("embedding") == dimensions) & F.coalesce(usable, F.lit(False)))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("v"))


def first_centroids(rows: DataFrame, k: int = K, seed: str = SEED) -> list[list[int]]:
    """The vectors with the k smallest SHA-256 of ``<seed>:<vec_id>`` (a null id is empty), equal ids by vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), id_text("vec_id")), 256)
    return [list(r["v"]) for r in rows.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest of ``centroids`` to the column v."""
    numbers = F.lit([[n, *c] for n, c in enumerate(centroids)]).cast("array<array<bigint>>")
    squared = lambda c: F.aggregate(
        F.zip_with("v", F.slice(c, 2, len(centroids[0])), lambda x, y: (x - y) * (x - y)),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )
    return F.array_min(
        F.transform(numbers, lambda c: F.struct(squared(c).alias("distance"), c[0].cast("int").alias("cluster")))
    )


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: the floor of the mean of their vectors; without vectors they stay."""
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    placed = rows.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    out = list(centroids)
    for r in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(centroids[0]))]
    return out


def fingerprint(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    dimensions: int = DIMENSIONS,
    k: int = K,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """Per usable vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    See :func:`integer_vectors` for what is usable. With fewer than ``k``
    vectors each one starts a centroid; equal starting centroids are allowed,
    the later ones stay empty. Without any vector the result is empty.
    The centroids (k x dimensions numbers) are the only thing the driver holds.
    Rounds end early where no centroid moved: all later rounds would give the same.
    """
    rows = stage(integer_vectors(vectors, dimensions, scale), "vectors")
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, moved(rows, centroids)
        if centroids == before:
            break
    if not centroids:
        return rows.select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    placed = stage(rows.select("vec_id", nearest(centroids).alias("at")).select("vec_id", "at.cluster", "at.distance"), "clusters")
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    by_number = lambda values, kind: F.lit(values).cast(f"array<{kind}>")[F.col("cluster")]
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        by_number([inertia.get(n, 0) for n in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        by_number([fingerprint(c) for c in centroids], "string").alias("centroid_sha256"),
    )
