"""Centroid clustering in JVM expressions (operator 13): k-means over integer vectors.

A kept vector becomes an array of integers once (``floor(scale * x)``) and is stored; every round is one scan of that table with built-in
functions only: ``zip_with`` and ``aggregate`` give the squared distance to each centroid, which stands in the plan as a literal
array, ``array_min`` of structs (distance, number) picks the cluster with ties to the smaller number, and one hash aggregate
with a sum for each component, combined on the map side, gives ``k`` rows from which the next centroids follow. So a round
shuffles at most ``k`` rows a task, whatever the sizes of the clusters, and the driver holds ``k`` centroids. Integers
make sums and distances exact: rows may arrive in any order, and a retried task repeats its result.

Kept: vectors of exactly ``width`` components, none null, NaN or infinite; others are left out. Components are held to LARGEST in
either direction, so that a distance fits a long. Rows with a null id are clustered, but start no centroid. Repeated
rows and ids count one by one; equal hashes are ordered by the vector, so two starts may be equal, and the smaller number takes their
rows. Fewer than ``k`` vectors give fewer centroids, an empty table gives no rows. Other columns are ignored. An inertia beyond a long is null.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldgauge.llm.registry import query, table
from foldgauge.session import materialize

CLUSTERS = 8
ROUNDS = 10
WIDTH = 64
SCALE = 1024
SALT = "3"
LARGEST = 1 << 27


def whole_vectors(df: DataFrame, id_column: str, vector_column: str, width: int, scale: int) -> DataFrame:
    """(id, vector) of the rows that are kept, components as integers."""
    values = F.col(vector_column).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = df.where((F.size(values) == width) & finite)
    scaled = F.transform(values, lambda x: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x * scale))).cast("int"))
    return kept.select(F.col(id_column).alias("id"), scaled.alias("vector"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The vectors whose ids hash least; ``k`` rows come to the driver."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    least = vectors.where(F.col("id").isNotNull()).select(mark.alias("mark"), "vector").orderBy("mark", "vector").limit(k)
    return [list(row.vector) for row in least.collect()]


def nearest_centroid(vector: str, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid, the smaller number among equals. SQL text, as one call builds it."""
    ranked = []
    for number, centroid in enumerate(centroids):
        there = ", ".join(f"{x}L" for x in centroid)
        apart = f"zip_with({vector}, array({there}), (a, b) -> (a - b) * (a - b))"
        ranked.append(f"named_struct('distance', aggregate({apart}, 0L, (total, x) -> total + x), 'cluster', {number})")
    return F.expr(f"array_min(array({', '.join(ranked)}))")


def moved_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: each centroid becomes the floor of its vectors' mean, an empty one stays."""
    width = len(centroids[0])
    near = vectors.select(nearest_centroid("vector", centroids)["cluster"].alias("cluster"), "vector")
    sums = [F.expr(f"sum(cast(vector[{i}] AS bigint))") for i in range(width)]
    moved = [list(c) for c in centroids]
    for cluster, n, *totals in near.groupBy("cluster").agg(F.count(F.lit(1)), *sums).collect():
        moved[cluster] = [total // n for total in totals]
    return moved


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    salt: str = SALT,
) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every kept vector, a stored table, and the centroids after the last round."""
    vectors = materialize(whole_vectors(df, id_column, vector_column, width, scale))
    centroids = first_centroids(vectors, k, salt)
    if not centroids:
        none = vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where(F.lit(False))
        return none.withColumnRenamed("id", id_column), []
    for _ in range(rounds):
        centroids = moved_centroids(vectors, centroids)
    near = vectors.select("id", nearest_centroid("vector", centroids).alias("near"))
    assigned = near.select(F.col("id").alias(id_column), F.col("near.cluster").alias("cluster"), F.col("near.distance").alias("distance"))
    return materialize(assigned), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with its cluster's and the total sum of distances and the digest of its centroid, as literals of ``k`` entries."""
    spread = {row.cluster: row.total for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def as_long(value: int) -> Column:
        return F.lit(int(value) if value < 1 << 63 else None).cast("long")

    def by_cluster(values: list[Column]) -> Column:
        return F.element_at(F.array(*values), F.col("cluster") + 1)

    each = [as_long(spread.get(n, 0)) for n in range(len(centroids))]
    digests = [F.lit(centroid_digest(c)) for c in centroids]
    if not centroids:
        each, digests = [as_long(0)], [F.lit("")]
    return assigned.select(
        "*",
        by_cluster(each).alias("cluster_inertia"),
        as_long(reduce(lambda a, b: a + b, spread.values(), 0)).alias("inertia"),
        by_cluster(digests).alias("centroid_sha256"),
    )


def _clusters_sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The rounds as one chain of tables: components as rows, floors of exact integer sums."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}
), axes AS MATERIALIZED (SELECT r, unnest(range(1, {WIDTH} + 1)) AS i, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT n, unnest(range(1, {WIDTH} + 1)) AS i, unnest(v) AS x
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{SALT}:' || vec_id), v) - 1 AS n FROM kept WHERE vec_id IS NOT NULL) WHERE n < {k}
)"""
    ]
    for step in range(rounds + 1):
        parts.append(
            f"""a{step} AS MATERIALIZED (
  SELECT r, arg_min(n, {{'d': d, 'n': n}}) AS n, min(d) AS d
  FROM (SELECT r, n, sum((axes.x - c.x) * (axes.x - c.x)) AS d FROM axes JOIN c{step} AS c USING (i) GROUP BY r, n) GROUP BY r
)"""
        )
        if step < rounds:
            parts.append(
                f"""c{step + 1} AS MATERIALIZED (
  SELECT n, i, coalesce(m.x, c.x) AS x FROM c{step} AS c LEFT JOIN (
    SELECT n, i, CAST((s - ((s % t) + t) % t) // t AS BIGINT) AS x
    FROM (SELECT n, i, sum(x) AS s, count(*) AS t FROM axes JOIN a{step} USING (r) GROUP BY n, i)
  ) AS m USING (n, i)
)"""
            )
    chain = ",\n".join(parts)
    return f"""WITH {chain}, marks AS (
  SELECT n, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY n
)
SELECT vec_id, CAST(n AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN marks USING (n)"""


@query("op13_clusters", _clusters_sql())
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    return with_inertia(assigned, centroids)


__all__ = ["cluster_vectors", "first_centroids", "moved_centroids", "nearest_centroid", "whole_vectors", "with_inertia"]
