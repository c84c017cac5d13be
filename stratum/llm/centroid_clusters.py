"""Clusters of embeddings around integer centroids.

Vectors become integers once and are written to the shared folder. Every round reads them in one pass: ``zip_with`` and
``aggregate`` give the integer distances to the centroids, which are literal arrays of the plan, ``array_min`` of
(distance, number) structs chooses the cluster, and generated code sums counts and components per cluster on the map
side. A round sends one row a cluster through its shuffle and to the driver, whatever the number of vectors, so one
vector held by a third of all rows costs what others cost. Everything is DataFrame functions.

Defined results: vectors that are NULL, of another size, or hold a NULL, NaN or infinite component are left out; so is
everything if none remains. Fewer vectors than centroids give a centroid each. Rows of one vec_id start centroids in the
order of their components, rows without vec_id come after all others; repeated rows are rows like any other, and equal
centroids leave all but the first without vectors. Only the id and vector columns are read. Arithmetic is exact for
components up to ``LARGEST`` in size; larger ones fail the job, as their squares would not fit a long.
"""

from __future__ import annotations

import dataclasses
import hashlib

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from stratum.scratch import staged

#: 64 squared differences of this many 256ths fit a long.
LARGEST = 2 ** 19


@dataclasses.dataclass(frozen=True)
class Settings:
    size: int = 64
    clusters: int = 40
    rounds: int = 5
    scale: int = 256
    salt: str = "2:"
    #: expected rows of the first try for the starting vectors, in multiples of ``clusters``
    margin: int = 4


Centroids = list[list[int]]


def integers(vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, start, x): whole vectors as integers, and the hash that orders the starting ones."""
    usable = (F.size(vector) == settings.size) & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(vector, lambda v: F.when(
        F.abs(v) <= LARGEST, F.floor(v.cast("double") * settings.scale)).otherwise(
        F.raise_error(F.lit(f"a component above {LARGEST}")).cast("long")))
    return vectors.filter(usable).select(
        F.col(key).alias("vec_id"), F.sha2(F.concat(F.lit(settings.salt), F.col(key).cast("string")), 256).alias("start"),
        whole.alias("x"))


def starting(rows: DataFrame, settings: Settings) -> Centroids:
    """The vectors of the smallest hashes. Only rows below a cut among the hashes are ordered and collected."""
    total = rows.count()
    order = [F.col("start").asc_nulls_last(), "x"]
    wanted = settings.margin * settings.clusters
    while wanted < total:
        cut = format(min(2 ** 64 - 1, wanted * 2 ** 64 // total), "016x")
        found = rows.filter(F.col("start") < cut).orderBy(*order).limit(settings.clusters).collect()
        if len(found) == settings.clusters:
            return [list(r.x) for r in found]
        wanted *= max(2, settings.margin)
    return [list(r.x) for r in rows.orderBy(*order).limit(settings.clusters).collect()]


def nearest(centroids: Centroids) -> Column:
    """The least (beyond, cluster) over the centroids: |c|^2 - 2 x.c is the distance without |x|^2, which all share."""
    candidates = ", ".join(
        f"named_struct('beyond', {sum(v * v for v in c)}L - 2L * aggregate("
        f"zip_with(x, array({', '.join(f'{v}L' for v in c)}), (a, b) -> a * b), 0L, (total, v) -> total + v), 'cluster', {i})"
        for i, c in enumerate(centroids))
    return F.expr(f"array_min(array({candidates}))")  # as text: thousands of literals, one call to the JVM


def assigned(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """``rows`` with cluster and distance (squared) of the nearest centroid; the smaller number wins ties."""
    length = F.aggregate("x", F.lit(0).cast("long"), lambda total, v: total + v * v)
    return rows.withColumn("nearest", nearest(centroids)).select(
        *rows.columns, F.col("nearest.cluster").alias("cluster"), (F.col("nearest.beyond") + length).alias("distance"))


def moved(rows: DataFrame, centroids: Centroids) -> Centroids:
    """Centroids of the next round: floors of the means; empty clusters keep theirs."""
    sums = assigned(rows, centroids).groupBy("cluster").agg(
        F.count("*").alias("n"), *(F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(len(centroids[0]))))
    following = list(centroids)
    for r in sums.collect():  # a row for each cluster
        following[r.cluster] = [r[f"s{i}"] // r.n for i in range(len(centroids[0]))]
    return following


def fitted(rows: DataFrame, settings: Settings = Settings()) -> Centroids:
    centroids = starting(rows, settings)
    for _ in range(settings.rounds if centroids else 0):
        centroids = moved(rows, centroids)
    return centroids


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding",
              ) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, distance) of each usable row, written once, and the final centroids."""
    rows = staged(integers(vectors, settings, key, vector), "integer-vectors")
    centroids = fitted(rows, settings)
    found = assigned(rows, centroids) if centroids else rows.withColumns(
        {"cluster": F.lit(0), "distance": F.lit(0).cast("long")})
    return staged(found.select("vec_id", "cluster", "distance"), "clusters"), centroids


def report(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row for each usable vector, with the sums of distances and its centroid's digest."""
    found, centroids = clustered(vectors, settings)
    sums: list[Row] = found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # a row for each cluster
    inertia = {r.cluster: r.d for r in sums}
    every = range(len(centroids))
    per_cluster = F.array(*(F.lit(inertia.get(i, 0)).cast("long") for i in every)) if centroids else F.array(
        F.lit(0).cast("long"))
    digests = F.array(*(F.lit(digest(c)) for c in centroids)) if centroids else F.array(F.lit(""))
    return found.select(
        "vec_id", "cluster", "distance", per_cluster[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), digests[F.col("cluster")].alias("centroid_sha256"))
