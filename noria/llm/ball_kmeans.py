"""Centroid clustering by ball k-means, in exact integers.

A cluster is a ball: its centroid and a radius no member lies beyond.  Another centroid
whose half distance is over the radius can take no member, so it is no neighbour.  A
member nearer to its centroid than half the way to the nearest neighbour lies in the
stable core and stays; the others lie in annuli between the half distances, and are
compared with the neighbours inside their annulus only.  Every test is made on squared
integers, so the outcome is that of comparing all vectors with all centroids.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noria.llm.common import Scratch, own

#: A component's greatest size, so that squared distances of up to 256 components are 64-bit.
MOST = 1 << 27


@dataclass
class Balls:
    """centroids: (k, d) integers.  near[i]: the neighbours of i, nearest first; apart[i]: their squared distances from i."""

    centroids: np.ndarray
    near: list[np.ndarray] | None = None
    apart: list[np.ndarray] | None = None


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x from c, exact."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def neighbours(centroids: np.ndarray, radii: np.ndarray) -> Balls:
    """radii: no member lies beyond; 0 for an empty cluster."""
    near, apart = [], []
    for i in range(len(centroids)):
        between = squared(centroids, centroids[i])
        order = np.lexsort((np.arange(len(centroids)), between))
        # half the distance against the radius, with room for the square roots' rounding
        order = order[(order != i) & (np.sqrt(between[order]) <= 2 * radii[i] * (1 + 1e-9) + 1e-6)]
        near.append(order)
        apart.append(between[order])
    return Balls(centroids, near, apart)


def nearest(x: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number at a tie, by comparison with all."""
    best, at = squared(x, balls.centroids[0]), np.zeros(len(x), np.int64)
    for j in range(1, len(balls.centroids)):
        d = squared(x, balls.centroids[j])
        closer = d < best
        best[closer], at[closer] = d[closer], j
    return at, best


def reassign(x: np.ndarray, cluster: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray]:
    """As `nearest`, for rows that lie in the balls of `cluster`."""
    at, best = cluster.copy(), squared(x, balls.centroids[cluster])
    order = np.argsort(cluster, kind="stable")
    bounds = np.searchsorted(cluster[order], np.arange(len(balls.centroids) + 1))
    for i in np.unique(cluster):
        mine = order[bounds[i] : bounds[i + 1]]
        # neighbours at twice the own distance or less; the rest are farther than the own centroid
        inside = np.searchsorted(balls.apart[i], 4 * best[mine], side="right")
        mine, inside = mine[inside > 0], inside[inside > 0]
        for j in range(int(inside.max(initial=0))):
            here = mine[inside > j]
            c = int(balls.near[i][j])
            d = squared(x[here], balls.centroids[c])
            closer = (d < best[here]) | ((d == best[here]) & (c < at[here]))
            best[here[closer]], at[here[closer]] = d[closer], c
    return at, best


def _assign(sent, dims: int):
    def run(batches):
        for batch in batches:
            v = batch.column(1)
            x = np.asarray(v.flatten()).astype(np.int64).reshape(-1, dims)
            if len(x) and np.abs(x).max() > MOST:
                raise ValueError(f"a component is over {MOST} after scaling; distances would not be 64-bit")
            balls = sent.value
            at, best = nearest(x, balls) if balls.near is None else reassign(x, np.asarray(batch.column(2)).astype(np.int64), balls)
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array(at.astype(np.int32)), pa.array(best)], ["id", "v", "cluster", "distance"])

    return run


def ball_kmeans(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256, one per vector that is clustered.

    Vectors of exactly `dims` components, none null or non-finite, are clustered; others
    have no row.  A component x becomes floor(scale * x).  The first centroids are the k
    vectors with the smallest sha256 of `seed:id` (all, if fewer; ids tie by the
    vector, a null id seeds nothing but is clustered).  Each round assigns all vectors
    and replaces every non-empty centroid by the floor of its mean; at the end all are
    assigned again.  Ties go to the smaller cluster number.  Repeated rows count as often
    as they stand.  An empty table gives no rows; a component beyond 2**27 after scaling
    is an error.  Extra columns are not read.

    A round is one pass over the vectors, kept in the shared folder with the clusters of
    the round before, and one aggregate of k rows, all that the driver gets.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    name = own([id_col], "v")["v"]
    whole = F.expr(f"transform(`{vector_col}`, x -> floor({scale}D * cast(x as double)))")
    fits = F.expr(f"size(`{vector_col}`) = {dims} and forall(`{vector_col}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    kept = vectors.where(fits).select(F.col(id_col).cast("long").alias("id"), whole.alias(name)).select("id", F.col(name).alias("v"))
    now = scratch.cut(kept.select("id", "v", F.lit(0).alias("cluster")), "vectors")
    first = now.where("id is not null").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), "v").limit(k).select("v").collect()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.ArrayType(T.LongType())), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not first:
        return spark.createDataFrame([], f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    balls = Balls(centroids)
    for at in range(rounds + 1):
        sent = spark.sparkContext.broadcast(balls)  # k centroids and their neighbours
        before, now = now, scratch.cut(now.select("id", "v", "cluster").mapInArrow(_assign(sent, dims), schema), f"round{at}")
        scratch.drop(before)
        if at < rounds:
            sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)]
            moved, radii = centroids.copy(), np.zeros(len(centroids))
            for r in now.groupBy("cluster").agg(F.count("*").alias("n"), F.max("distance").alias("far"), *sums).collect():
                c = r["cluster"]
                moved[c] = [r[f"s{i}"] // r["n"] for i in range(dims)]
                # no member is farther from the new centroid than from the old one plus the way between them
                radii[c] = math.sqrt(r["far"]) + math.sqrt(int(squared(moved[c : c + 1], centroids[c])[0]))
            centroids, balls = moved, neighbours(moved, radii)
    found = {r["cluster"]: r["far"] for r in now.groupBy("cluster").agg(F.sum("distance").alias("far")).collect()}
    total = sum(found.values())
    rows = [(c, n, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, n in sorted(found.items())]
    ends = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = now.select(F.col("id").alias(id_col), "cluster", "distance").join(F.broadcast(ends), "cluster")
    return out.select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256) -> str:
    """DuckDB SQL for `ball_kmeans` over embeddings: every vector against every centroid in each round (ids are unique)."""
    parts = [
        f"""v as materialized (select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as e from embeddings
            where embedding is not null and len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"c0 as materialized (select (row_number() over (order by sha256('{seed}:' || vec_id)) - 1)::int as c, e from v where vec_id is not null qualify c < {k})",
    ]
    for t in range(rounds + 1):
        parts.append(f"""a{t} as materialized (select vec_id, min({{'d': d, 'c': c}}) as best from (select v.vec_id, c{t}.c as c,
            list_sum(list_transform(list_zip(v.e, c{t}.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from v cross join c{t}) group by vec_id)""")
        if t < rounds:
            parts.append(f"""s{t} as (select best.c as c, i, sum(e[i])::bigint as s, count(*)::bigint as n from a{t} join v using (vec_id) cross join range(1, {dims + 1}) r(i) group by 1, 2),
            m{t} as (select c, list(((s - ((s % n + n) % n)) // n)::bigint order by i) as e from s{t} group by c),
            c{t + 1} as materialized (select c{t}.c as c, coalesce(m{t}.e, c{t}.e) as e from c{t} left join m{t} using (c))""")
    return "with " + ",\n".join(parts) + f"""
    select vec_id, best.c::int as cluster, best.d::bigint as distance, (sum(best.d) over (partition by best.c))::bigint as cluster_inertia, (sum(best.d) over ())::bigint as inertia,
           sha256(array_to_string(c{rounds}.e, ',')) as centroid_sha256
    from a{rounds} join c{rounds} on c{rounds}.c = best.c"""
