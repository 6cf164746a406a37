"""Ball k-means: clusters as balls, with exact comparisons of relevant neighbours alone.

A cluster is a ball of a centroid and a radius over its members. Another
cluster can take a member only if its centroid is at most twice the radius
away; such clusters are the neighbours. Members nearer to their centroid than
half the way to the nearest neighbour are the stable core and stay without a
comparison. The rest lies in annuli: a member between half the ways to two
neighbours is compared with those up to the nearer one. All in whole numbers,
so the result equals that of comparing every pair.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch
from .integers import first_vectors, matrix, moved, quantised, summed_by, totals

SCALE, DIMENSIONS, CLUSTERS, ROUNDS = 64, 64, 16, 3


@dataclass
class Balls:
    """Centroids with bounds of their squared radii (None: unknown), and each one's neighbours from the nearest on."""

    centres: np.ndarray
    radii: list[int] | None = None

    def __post_init__(self):
        c = self.centres
        self.apart = ((c[:, None, :] - c[None, :, :]) ** 2).sum(2)
        self.near = []
        for a in range(len(c)):
            order = [int(j) for j in np.argsort(self.apart[a], kind="stable") if j != a]
            self.near.append([j for j in order if self.radii is None or self.apart[a, j] <= 4 * self.radii[a]])

    def assign(self, v: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance, comparisons) of rows from the cluster that each is in; ties to the smaller number."""
        to, far, made = cluster.copy(), np.zeros(len(v), np.int64), len(v)
        for a in np.unique(cluster):
            mine = np.flatnonzero(cluster == a)
            x = v[mine]
            own = ((x - self.centres[a]) ** 2).sum(1)
            best, least = np.full(len(mine), a), own.copy()
            # Rows by distance: those that a neighbour may take are behind its half way, and each next neighbour has fewer.
            order = np.argsort(own, kind="stable")
            reach = 4 * own[order]
            for j in self.near[a]:
                outer = order[np.searchsorted(reach, self.apart[a, j], "left") :]
                if not len(outer):
                    break
                made += len(outer)
                d = ((x[outer] - self.centres[j]) ** 2).sum(1)
                better = (d < least[outer]) | ((d == least[outer]) & (j < best[outer]))
                taken = outer[better]
                best[taken], least[taken] = j, d[better]
            to[mine], far[mine] = best, least
        return to, far, made

    def after(self, centres: np.ndarray, farthest: np.ndarray) -> Balls:
        """The balls around moved centres: a radius grows by its centre's way at most."""
        way = np.sqrt(((centres - self.centres) ** 2).sum(1).astype(float))
        radii = [math.ceil(((math.sqrt(int(f)) + w) * (1 + 1e-9) + 1e-6) ** 2) for f, w in zip(farthest, way, strict=True)]
        return Balls(centres, radii)


def assigned(rows: DataFrame, balls: Balls) -> DataFrame:
    """id, v, cluster, distance of rows of id, v, cluster."""
    key = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n = len(batch)
            to, far = balls.assign(matrix(batch.column("v")), batch.column("cluster").to_numpy())[:2] if n else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(to.astype(np.int32)), pa.array(far)], ["id", "v", "cluster", "distance"])

    return rows.select("id", "v", "cluster").mapInArrow(run, f"id {key}, v array<int>, cluster int, distance bigint")


def cluster_sums(rows: DataFrame, clusters: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) over all rows by cluster; tasks add up, a grouped shuffle merges."""
    shape = (clusters, dimensions + 1)

    def task(batches):
        out = np.zeros(shape, np.int64)
        for batch in batches:
            if len(batch):
                sums, counts = summed_by(batch.column("cluster").to_numpy(), matrix(batch.column("v")), clusters)
                out[:, :-1] += sums
                out[:, -1] += counts
        return out.reshape(-1)

    told = totals(rows.select("v", "cluster"), task, clusters * (dimensions + 1)).reshape(shape)
    return told[:, :-1], told[:, -1]


def cluster(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """vec_id (under ``key``), cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept row.

    Rows whose vector is null, of another length, or holds null or non-finite
    components go. Repeated rows are vectors of their own with rows of their
    own, and each may be a first centroid; rows of one key come in the order of
    their vectors; a null key hashes as the empty string; fewer rows than
    clusters give as many centroids; other columns are ignored; an empty table
    gives an empty result. Components beyond 2,097,152 raise an error.

    Each round's rows are written to the shared folder beside those that they
    come from, which are then removed; what goes to the driver is a centroid's
    sums, whatever the rows.
    """
    spark = vectors.sparkSession
    rows, path = quantised(vectors, scale, key=key, vector=vector, dimensions=dimensions)
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    centres = first_vectors(rows, [named], clusters)
    if not len(centres):
        return rows.select(F.col("id").alias(key), F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).limit(0)
    balls, rows = Balls(centres), rows.withColumn("cluster", F.lit(0))
    for k in range(rounds + 1):
        to = scratch(spark, f"balls-{k}")
        assigned(rows, balls).write.option("compression", "zstd").parquet(to)
        discard(spark, path)
        rows, path = spark.read.parquet(to), to
        per = {r.cluster: r for r in rows.groupBy("cluster").agg(F.max("distance").alias("far"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()}
        if k < rounds:
            sums, counts = cluster_sums(rows, len(centres), dimensions)
            farthest = np.array([per[a].far if a in per else 0 for a in range(len(centres))])
            balls = balls.after(moved(balls.centres, sums, counts), farthest)
    whole = sum(int(r["sum"]) for r in per.values())
    # One row a centroid, of a fixed number.
    told = [(a, int(r["sum"]), whole, hashlib.sha256(",".join(map(str, balls.centres[a].tolist())).encode()).hexdigest()) for a, r in sorted(per.items())]
    by_cluster = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(by_cluster), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql() -> str:
    out = []
    for k in range(ROUNDS + 1):
        out.append(f"""a{k} AS MATERIALIZED (SELECT r, cluster, far FROM (SELECT x.r, b.cluster, sum((x.x - b.c) * (x.x - b.c)) AS far FROM cells x JOIN c{k} b USING (pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY far, cluster) = 1)""")
        if k < ROUNDS:
            out.append(f"""c{k + 1} AS MATERIALIZED (SELECT cluster, pos, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), c) AS c FROM c{k}
  LEFT JOIN (SELECT cluster, pos, sum(x) AS s, count(*) AS n FROM cells JOIN a{k} USING (r) GROUP BY ALL) USING (cluster, pos))""")
    return ",\n".join(out)


CLUSTER_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) AS r, vec_id, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (SELECT r, pos, CAST(floor({SCALE} * CAST(embedding[pos + 1] AS DOUBLE)) AS BIGINT) AS x FROM kept, range({DIMENSIONS}) AS q(pos)),
c0 AS MATERIALIZED (SELECT r - 1 AS cluster, pos, x AS c FROM cells WHERE r <= {CLUSTERS}),
{_rounds_sql()},
named AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(far AS BIGINT) AS distance, CAST(sum(far) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{ROUNDS} USING (r) JOIN named USING (cluster)
"""
