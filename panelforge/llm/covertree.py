"""Exact top-k search by inner product: dual-tree traversal of cover trees over queries and candidates."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import arrow_schema, materialise, one_blas_thread, ship, to_batch

#: Vectors in a block; a tree is built over each block.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 1024
#: A node with so few vectors is not split further: its scores are one matrix product.
LEAF = 256
#: The covering distance falls by this factor from level to level.
BASE = 1.2
#: Vectors that the anchors of the blocks are chosen from, and anchors, at most.
SAMPLE, ANCHORS = 4096, 256
#: Query blocks that one task holds against a candidate block.
SHARE = 8
#: Below all scores.
NONE = -(2**63)
FLOORS = "array<struct<query_id:bigint,kth:bigint>>"


@dataclass
class CoverTree:
    """A simplified cover tree (Izbicki and Shelton, 2015) over a permutation of the vectors.

    Node i covers ``order[first[i]:last[i]]`` and is centred at one of its vectors. At level l the covering distance is
    cover(l) = top / BASE**l. Covering: no vector of a node at level l is further than cover(l) from its centre;
    ``radius`` is the largest such distance. Separation: children of a node at level l are centred more than
    cover(l + 1) apart, as each is the vector farthest from those before it. Nesting: the first child has its parent's
    centre. Levels that would hold a node with itself as its only child are skipped. Nodes of at most LEAF vectors, or of
    equal ones, are leaves.
    """

    vectors: np.ndarray
    order: np.ndarray
    first: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    centre: list[int] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    level: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    top: float = 0.0

    @classmethod
    def build(cls, vectors: np.ndarray, leaf: int = LEAF) -> CoverTree:
        tree = cls(vectors, np.arange(len(vectors)))
        if len(vectors):
            tree._grow(vectors.astype(np.float64), leaf)
        return tree

    def cover(self, level: int) -> float:
        return self.top / BASE**level

    def _grow(self, x: np.ndarray, leaf: int) -> None:
        middle = int(_distance(x, x.mean(axis=0)).argmin())
        self.top = float(_distance(x, x[middle]).max())
        stack = [(0, len(x), -1, middle, 0)]
        while stack:
            first, last, parent, centre, level = stack.pop()
            some = self.order[first:last]
            far = _distance(x[some], x[centre])
            reach = float(far.max())
            while 0 < reach <= self.cover(level + 1):
                level += 1
            node = len(self.first)
            for held, value in ((self.first, first), (self.last, last), (self.centre, centre), (self.radius, reach), (self.level, level), (self.parent, parent), (self.children, [])):
                held.append(value)
            if parent >= 0:
                self.children[parent].append(node)
            if last - first <= leaf or reach == 0.0:
                continue
            centres, nearest = net(x[some], far, self.cover(level + 1))
            centres = [centre, *some[centres].tolist()]
            self.order[first:last] = some[np.argsort(nearest, kind="stable")]
            edges = first + np.cumsum([0, *np.bincount(nearest, minlength=len(centres))])
            stack += reversed([(int(a), int(b), node, c, level + 1) for c, a, b in zip(centres, edges, edges[1:])])

    def packed(self) -> dict[str, bytes]:
        whole = np.array([self.first, self.last, self.centre, self.level, self.parent], "<i8")
        return {"order": self.order.astype("<i8").tobytes(), "nodes": whole.tobytes(), "radii": np.array([self.top, *self.radius], "<f8").tobytes()}

    @classmethod
    def unpacked(cls, vectors: np.ndarray, order: bytes, nodes: bytes, radii: bytes) -> CoverTree:
        first, last, centre, level, parent = np.frombuffer(nodes, "<i8").reshape(5, -1).tolist()
        top, *radius = np.frombuffer(radii, "<f8").tolist()
        children: list[list[int]] = [[] for _ in first]
        for node, above in enumerate(parent):
            if above >= 0:
                children[above].append(node)
        return cls(vectors, np.frombuffer(order, "<i8"), first, last, centre, radius, level, parent, children, top)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - y) ** 2).sum(axis=1))


def net(x: np.ndarray, far: np.ndarray, cover: float, most: int | None = None) -> tuple[list[int], np.ndarray]:
    """Farthest first: vectors picked until all lie within ``cover`` of a pick or of the start, which they are ``far`` from
    (or until ``most`` are picked), and the nearest of the start (0) and the picks (from 1) to each vector."""
    near, nearest, picked = far.copy(), np.zeros(len(x), dtype=np.int64), []
    while most is None or len(picked) < most:
        k = int(near.argmax())
        if near[k] <= cover:
            break
        picked.append(k)
        d = _distance(x, x[k])
        closer = d < near
        near[closer], nearest[closer] = d[closer], len(picked)
    return picked, nearest


class TopK:
    """The k best (score, smaller id first) of each query so far. ``floor``: what a score must reach besides."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE, dtype=np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)
        self.held = np.zeros((n, k), dtype=bool)
        self.floor = np.full(n, NONE, dtype=np.int64)

    def worst(self, rows: np.ndarray) -> int:
        """The lowest kth score in a group of queries: nothing below it can enter any of them."""
        return int(np.maximum(self.score[rows, -1], self.floor[rows]).min())

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """scores, allowed: (rows, candidates)."""
        floor = np.maximum(self.score[rows, -1], self.floor[rows])
        if scores.shape[1] > self.k + 1:  # one more than k, as the query's own vector may be among them
            floor = np.maximum(floor, np.partition(scores, -self.k - 1, axis=1)[:, -self.k - 1])
        may = (scores >= floor[:, None]) & allowed  # ties at the kth score stay in
        for r in np.flatnonzero(may.any(axis=1)):
            self._merge(int(rows[r]), scores[r, may[r]], ids[may[r]])

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        held = self.held[q]
        s, i = np.append(self.score[q, held], scores), np.append(self.ids[q, held], ids)
        best = np.lexsort((i, -s))[: self.k]
        self.score[q, : len(best)], self.ids[q, : len(best)], self.held[q, : len(best)] = s[best], i[best], True


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products of integer vectors, exact: in double precision where no sum can pass 2**53, else in 64 bits."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1]
    if most < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("inner products must fit into 64 bits")
    return x.astype(np.int64) @ y.astype(np.int64).T


def dual_search(queries: CoverTree, query_ids: np.ndarray, candidates: CoverTree, candidate_ids: np.ndarray, top: TopK) -> int:
    """Offer to ``top`` all candidates that can matter; returns the number of leaf pairs scored.

    For any q, x in a pair of nodes with centres p, c and radii r, s: <q,x> <= <p,c> + r|c| + s|p| + r s. A pair whose bound
    is below the worst kth score of the query node is pruned; more promising pairs are taken first. A candidate with
    the query's own id takes no part.
    """
    if not len(query_ids) or not len(candidate_ids):
        return 0
    p, c = queries.vectors[queries.centre].astype(np.float64), candidates.vectors[candidates.centre].astype(np.float64)
    r, s = np.array(queries.radius), np.array(candidates.radius)
    norm_p, norm_c = np.sqrt((p**2).sum(axis=1)), np.sqrt((c**2).sum(axis=1))
    # the last factor is above all rounding errors of the terms
    slack = 1 + 1e-9

    def bounds(a, b) -> np.ndarray:
        return p[a] @ c[b].T + (r[a] * norm_c[b] + s[b] * norm_p[a] + r[a] * s[b]) * slack + norm_p[a] * norm_c[b] * 1e-9 + 1e-6

    scored, stack = 0, [(0, 0, float(bounds(0, 0)))]
    while stack:
        a, b, most = stack.pop()
        rows = queries.order[queries.first[a] : queries.last[a]]
        if most < top.worst(rows):
            continue
        if not queries.children[a] and not candidates.children[b]:
            some = candidates.order[candidates.first[b] : candidates.last[b]]
            top.offer(rows, products(queries.vectors[rows], candidates.vectors[some]), candidate_ids[some], query_ids[rows][:, None] != candidate_ids[some][None, :])
            scored += 1
            continue
        if queries.children[a] and (not candidates.children[b] or queries.radius[a] > candidates.radius[b]):
            pairs = [(x, b) for x in queries.children[a]]
            most = np.array([bounds(x, b) for x, _ in pairs])
        else:
            pairs = [(a, y) for y in candidates.children[b]]
            most = bounds(a, [y for _, y in pairs])
        stack += [(*pairs[i], float(most[i])) for i in np.argsort(most, kind="stable")]
    return scored


def _anchors(vectors: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` vectors, each the farthest from those before it, of a bounded sample."""
    rows = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").collect()
    x = np.array([r.v for r in rows], dtype=np.float64)
    picked, _ = net(x, _distance(x, x[0]), 0.0, n - 1)
    return x[[0, *picked]]


def _blocks(vectors: DataFrame, anchors: np.ndarray, block: int, width: int, name: str) -> DataFrame:
    """(block, ids, data, order, nodes, radii, centre, radius): blocks of near vectors, each with its tree, built once.

    A vector goes to its nearest anchor; the vectors of an anchor are dealt into blocks of about ``block`` by a hash, so
    that one task never holds more, however many vectors are equal.
    """
    kind = "vec_id bigint, v array<bigint>, cell int"
    arrow = arrow_schema(kind)
    ship(vectors.sparkSession)

    def assign(batches):
        one_blas_thread()
        half = (anchors**2).sum(axis=1) / 2
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                if part.num_rows:
                    x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)
                    yield to_batch({"vec_id": part.column(0), "v": part.column(1), "cell": (x @ anchors.T - half).argmax(axis=1)}, arrow)

    placed = materialise(vectors.select("vec_id", "v").mapInArrow(assign, kind), "cells")
    parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))  # a row for each anchor
    placed = placed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        one_blas_thread()
        group = group.sort_values("vec_id", kind="stable")
        data = np.array(group["v"].tolist(), dtype="<i8")
        tree = CoverTree.build(data)
        row = {"block": (int(group["cell"].iloc[0]) << 32) + int(group["part"].iloc[0]), "ids": group["vec_id"].to_numpy("<i8").tobytes(), "data": data.tobytes()}
        return pd.DataFrame([row | tree.packed() | {"centre": data[tree.centre[0]].astype("f8").tolist(), "radius": tree.radius[0]}])

    schema = "block bigint, ids binary, data binary, order binary, nodes binary, radii binary, centre array<double>, radius double"
    return materialise(placed.select("cell", "part", "vec_id", "v").groupBy("cell", "part").applyInPandas(grow, schema), name)


def search(
    vectors: DataFrame, queries: DataFrame, *, k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of ``vectors`` by inner product, ties to the smaller id.

    Both frames are (vec_id long, v array<long>). Queries and candidates are put into blocks of near vectors, each with
    a cover tree that is built once. Every block of queries first meets its nearest block of candidates, which gives
    each query a kth score to beat. Of all other pairs of blocks only the summaries (centre and radius) meet; a pair
    whose bound is below the worst kth score of its queries moves no data, and the trees of the others are searched
    together. Scores are exact integers; sums must fit into 64 bits, else an error is raised.

    Rows with a null id, a null vector or null components take no part, nor do vectors of another length than the
    queries' in the pair. Repeated candidate rows count once; fewer than k candidates give fewer rows; no query or no
    candidate gives none. Other columns take no part.
    """
    clean = lambda df: df.select("vec_id", "v").where("vec_id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null)").dropDuplicates()
    widths = lambda df: df.withColumn("width", F.size("v"))
    out: DataFrame | None = None
    every, asked = widths(clean(vectors)), widths(clean(queries))
    for width in sorted(r.width for r in asked.select("width").distinct().collect()):
        found = _search_width(every.where(F.col("width") == width), asked.where(F.col("width") == width), width, k, query_block, candidate_block)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return clean(queries).selectExpr("vec_id query_id", "1 rank", "vec_id", "vec_id score").where("false")
    return out


def _search_width(vectors: DataFrame, queries: DataFrame, width: int, k: int, query_block: int, candidate_block: int) -> DataFrame | None:
    n = vectors.count()
    if not n:
        return None
    anchors = _anchors(vectors, min(ANCHORS, math.ceil(n / candidate_block)))
    right, left = _blocks(vectors, anchors, candidate_block, width, "candidates"), _blocks(queries, anchors, query_block, width, "queries")
    a, b = left.select(F.col("block").alias("qb"), F.col("centre").alias("p"), F.col("radius").alias("r")), right.select(F.col("block").alias("cb"), F.col("centre").alias("c"), F.col("radius").alias("s"))
    summaries = a.crossJoin(b).withColumns({"dot": _dot("p", "c"), "pp": F.sqrt(_dot("p", "p")), "cc": F.sqrt(_dot("c", "c"))})
    bound = F.col("dot") + (F.col("r") * F.col("cc") + F.col("s") * F.col("pp") + F.col("r") * F.col("s")) * (1 + 1e-9) + F.col("pp") * F.col("cc") * 1e-9 + 1e-6
    pairs = materialise(summaries.select("qb", "cb", bound.alias("bound"), (F.col("dot") - F.col("cc") * F.col("cc") / 2).alias("near")), "pairs")
    home = pairs.groupBy("qb").agg(F.max(F.struct("near", "cb")).alias("x")).select("qb", F.col("x.cb").alias("cb"))
    first = materialise(_met(home, left.withColumn("floors", F.lit(None).cast(FLOORS)), right, width, k), "found")
    # each query's kth score so far; its block's worst is what another block's bound must reach
    kth = first.groupBy("qb", "query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    floors = kth.groupBy("qb").agg(F.sort_array(F.collect_list(F.struct("query_id", F.coalesce("kth", F.lit(NONE)).alias("kth")))).alias("floors"))
    asked = left.join(floors.withColumnRenamed("qb", "block"), "block", "left")
    worst = asked.select(F.col("block").alias("qb"), F.when(F.size("floors") * 8 == F.length("ids"), F.array_min(F.transform("floors", lambda x: x["kth"]))).alias("worst"))
    others = pairs.join(home.withColumnRenamed("cb", "at"), "qb").where("cb <> at").join(worst, "qb")
    others = others.where(F.coalesce(F.col("bound") >= F.col("worst"), F.lit(True))).select("qb", "cb")
    second = _met(others, asked, right, width, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = first.unionByName(second).select("query_id", "vec_id", "score").dropDuplicates()
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _met(pairs: DataFrame, left: DataFrame, right: DataFrame, width: int, k: int) -> DataFrame:
    """(qb, query_id, vec_id, score): what each pair (qb, cb) of blocks adds to its queries' k best.

    A candidate block goes to one task for each SHARE query blocks or so that it meets; query blocks are the smaller ones."""
    schema = "qb bigint, query_id bigint, vec_id bigint, score bigint"
    arrow = arrow_schema(schema)
    ship(left.sparkSession)
    times = pairs.groupBy("cb").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
    dealt = pairs.join(times, "cb").select("cb", F.pmod(F.xxhash64("qb"), F.col("shares")).cast("int").alias("share"), "qb")
    tree = ["ids", "data", "order", "nodes", "radii"]
    asked = dealt.join(left.withColumnRenamed("block", "qb"), "qb").select("cb", "share", "qb", *tree, "floors")
    heads = dealt.select("cb", "share").distinct().join(right.withColumnRenamed("block", "cb"), "cb").select("cb", "share", F.lit(None).cast("bigint").alias("qb"), *tree)
    heads = heads.withColumn("floors", F.lit(None).cast(FLOORS))
    grouped = heads.unionByName(asked).repartition("cb", "share").sortWithinPartitions("cb", "share", F.col("qb").asc_nulls_first())

    def run(batches):
        one_blas_thread()

        def read(ids, data, order, nodes, radii):
            return np.frombuffer(ids, "<i8"), CoverTree.unpacked(np.frombuffer(data, "<i8").reshape(-1, width), order, nodes, radii)

        ids = other = None
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, qb, *packed, floors = (c[row].as_py() for c in batch.columns)
                if qb is None:
                    ids, other = read(*packed)
                    continue
                query_ids, queries = read(*packed)
                top = TopK(len(query_ids), k)
                if floors:
                    known = {f["query_id"]: f["kth"] for f in floors}
                    top.floor[:] = [known.get(i, NONE) for i in query_ids.tolist()]
                dual_search(queries, query_ids, other, ids, top)
                rows, places = np.nonzero(top.held)
                yield to_batch({"qb": np.full(len(rows), qb), "query_id": query_ids[rows], "vec_id": top.ids[rows, places], "score": top.score[rows, places]}, arrow)

    return grouped.mapInArrow(run, schema)


def quantise(embeddings: DataFrame, *, scale: int = 256) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), x as double; vectors that are null or hold a null or a
    non-finite component are left out."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    ok = F.coalesce(F.forall(whole, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))
    floored = F.transform(whole, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return embeddings.where(ok).select("vec_id", floored.alias("v"))
