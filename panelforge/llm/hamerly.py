"""Centroid clustering with Hamerly's bounds: exact assignments in integers, most of them without a scan."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.common import drop_table, materialise, one_blas_thread, schema_to_arrow, ship

#: Components reach less than this after scaling, so that squared distances in 64 dimensions fit into 63 bits.
LIMIT = 2**27
#: Rows that are scanned at once.
CHUNK = 8192
#: Bounds are kept on the safe side of what floating point may lose in a round.
SLACK = 2.0**-48


@dataclass
class Centroids:
    """``points`` of this round, how far each ``moved`` since the last one and half the distance to its nearest other."""

    points: np.ndarray
    moved: np.ndarray
    half: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, before: np.ndarray | None) -> Centroids:
        moved = np.zeros(len(points)) if before is None else _root(((points - before) ** 2).sum(axis=1)) * (1 + SLACK)
        gaps = _root(distances(points, points)) * (1 - SLACK) / 2
        np.fill_diagonal(gaps, np.inf)
        return cls(points, moved, gaps.min(axis=1, initial=np.inf))


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def distances(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all points, exact: in floating point where all sums stay below 2**53, which BLAS
    does faster, else in integers."""
    top = max(np.abs(v).max(initial=0), np.abs(points).max(initial=0))
    kind = np.float64 if int(top) ** 2 * 4 * v.shape[1] < 2**53 else np.int64
    a, b = v.astype(kind), points.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)


def assign(v: np.ndarray, centroids: Centroids, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray):
    """(cluster, upper, lower, scanned) after a round. ``upper`` bounds a vector's distance to its centroid from above and
    ``lower`` that to its second nearest from below. The centroids' moves loosen both. While the upper one stays below
    the lower one, or below half the way from the centroid to the next, no other centroid is as near. Else the upper one
    is made exact, and if that does not decide, the vector is scanned against all, ties going to the smaller number.
    Cluster -1: not assigned yet."""
    points, moved = centroids.points, centroids.moved
    cluster = cluster.astype(np.int64)
    far = np.argsort(-moved, kind="stable")[:2]
    others = np.where(cluster == far[0], moved[far[1]] if len(far) > 1 else 0.0, moved[far[0]])
    new = cluster < 0
    own = np.where(new, 0, cluster)
    upper = np.where(new, np.inf, (upper + moved[own]) * (1 + SLACK))
    lower = np.where(new, -np.inf, lower - others - SLACK * np.abs(lower))
    enough = np.where(new, -np.inf, np.maximum(lower, centroids.half[own]))
    unsure = np.flatnonzero(~(upper < enough))
    near = unsure[~new[unsure]]
    upper[near] = _root(((v[near].astype(np.int64) - points[own[near]]) ** 2).sum(axis=1)) * (1 + SLACK)
    unsure = unsure[~(upper[unsure] < enough[unsure])]
    for start in range(0, len(unsure), CHUNK):
        rows = unsure[start : start + CHUNK]
        d = distances(v[rows], points)
        best = d.argmin(axis=1)  # the first of equals
        cluster[rows] = best
        at = np.arange(len(rows))
        upper[rows] = _root(d[at, best]) * (1 + SLACK)
        d[at, best] = np.iinfo(np.int64).max
        lower[rows] = _root(d.min(axis=1)) * (1 - SLACK) if len(points) > 1 else np.inf
    return cluster.astype(np.int32), upper, lower, len(unsure)


def quantise(df: DataFrame, *, vector_col: str = "embedding", dims: int = 64, scale: int = 256) -> DataFrame:
    """Rows of ``df`` whose vector has ``dims`` components, all finite, with ``__v``: components as floor(scale * x)."""
    whole = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double") * F.lit(float(scale)))
    ok = F.forall(whole, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float(LIMIT))), F.lit(False)))
    return df.where((F.size(F.col(f"`{vector_col}`")) == dims) & F.coalesce(ok, F.lit(False))).withColumn("__v", F.transform(whole, lambda x: F.floor(x).cast("int")))


def first_centroids(vectors: DataFrame, k: int, dims: int, seed: int, id_col: str = "__id") -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of seed and id, in this order (all, if fewer; ties by components)."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(spelled.cast("binary"), 256).alias("h"), "__v").orderBy("h", "__v").limit(k).collect()
    return np.array([r["__v"] for r in rows], dtype=np.int64).reshape(len(rows), dims)


def cluster(
    embeddings: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: list[str] | None = None,
) -> DataFrame:
    """Each vector with its cluster (int), distance (squared, to its centroid), cluster_inertia and inertia (distances
    summed over its cluster and over all) and centroid_sha256 (of its final centroid's components, joined by commas).

    Components become floor(scale * x). Centroids start as the ``k`` vectors with the smallest sha256 of ``seed``:id. Each
    of ``rounds`` rounds assigns every vector to the nearest one (ties: smaller number) and moves every non-empty
    centroid to the exact floor(sum / count) of its vectors; then vectors are assigned once more.

    Vectors and their two bounds are a table in the shared folder that each round writes anew, and the table before it is
    removed; a task reads its rows once and needs k x dims centroids. Vectors never move between tasks: a cluster that
    holds most of them is summed where they are. The driver gets k sums a round.

    Vectors that are null, have another number of components or hold a null or non-finite one take no part; nor do those
    with a component of 2**27 or more after scaling, whose distances do not fit into a long. A null id hashes as empty
    text. Repeated rows are vectors each. With fewer than ``k`` vectors each is a centroid; without any there is no row.
    ``keep`` names the columns that stay (all but the vector by default); those called like added ones are replaced.
    """
    spark = embeddings.sparkSession
    ship(spark)
    added = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    columns = [c for c in (embeddings.columns if keep is None else keep) if c not in added and (keep is not None or c != vector_col)]
    carried = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)]
    vectors = quantise(embeddings.select(*carried, F.col(f"`{id_col}`").alias("__id"), F.col(f"`{vector_col}`").alias("__vector")), vector_col="__vector", dims=dims, scale=scale)
    points = first_centroids(vectors, k, dims, seed)
    start = vectors.drop("__id", "__vector").withColumns({"cluster": F.lit(-1), "__upper": F.lit(0.0), "__lower": F.lit(0.0)})
    state, held, before = start, None, None
    for _ in range(rounds):
        held, old = materialise(_assigned(state, Centroids.of(points, before)), "clusters"), held
        if old is not None:
            drop_table(old)
        state, before = held, points
        points = _moved(held, points, dims)
    final = materialise(_assigned(state, Centroids.of(points, before), last=True), "clustered")
    if held is not None:
        drop_table(held)
    sums = {r.cluster: r.n for r in final.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points.tolist()]
    about = [(c, n, sum(sums.values()), digests[c]) for c, n in sums.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = final.join(F.broadcast(about), "cluster")  # at most k rows
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], *added)


def _assigned(state: DataFrame, centroids: Centroids, *, last: bool = False) -> DataFrame:
    """``state`` after a round; ``last``: with exact distances in place of vectors and bounds."""
    passed = [f for f in state.schema.fields if f.name.startswith("__c")]
    fields = [T.StructField("cluster", T.IntegerType())]
    fields += [T.StructField("distance", T.LongType())] if last else [state.schema["__v"], T.StructField("__upper", T.DoubleType()), T.StructField("__lower", T.DoubleType())]
    result = T.StructType([*passed, *fields])
    arrow = schema_to_arrow(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        for batch in batches:
            if not batch.num_rows:
                continue
            found = {n: c for n, c in zip(batch.schema.names, batch.columns)}
            v = found["__v"].flatten().to_numpy().reshape(batch.num_rows, -1)
            bounds = [found[c].to_numpy(zero_copy_only=False) for c in ("cluster", "__upper", "__lower")]
            chosen, upper, lower, _ = assign(v, centroids, *bounds)
            made = {"cluster": chosen, "__v": found["__v"], "__upper": upper, "__lower": lower}
            if last:
                made["distance"] = ((v.astype(np.int64) - centroids.points[chosen]) ** 2).sum(axis=1)
            arrays = [found[f.name].cast(f.type) if f.name.startswith("__c") else made[f.name] for f in arrow]
            yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, type=f.type) for a, f in zip(arrays, arrow)], schema=arrow)

    return state.mapInArrow(run, result)


def _moved(state: DataFrame, points: np.ndarray, dims: int) -> np.ndarray:
    """Every non-empty centroid at floor(sum / count) of its vectors, which tasks sum before anything is shuffled."""
    rows = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("__v")[i].cast("long")).alias(f"s{i}") for i in range(dims)]).collect()
    points = points.copy()
    for row in rows:  # k rows
        points[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    return points
