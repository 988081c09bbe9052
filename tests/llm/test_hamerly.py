"""Centroid clustering against a plain implementation, and what its bounds save."""

import hashlib
import math

import numpy as np
import pytest

from panelforge.llm import hamerly

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k, rounds, scale=256, dims=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    spelled = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    points = [v for _, v in sorted(kept, key=lambda r: (spelled(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assigned = lambda: [min((far(v, p), c) for c, p in enumerate(points)) for _, v in kept]
    for _ in range(rounds):
        groups = {}
        for (_, v), (_, c) in zip(kept, assigned()):
            groups.setdefault(c, []).append(v)
        points = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else p for c, p in enumerate(points)]
    best = assigned()
    sums = {}
    for d, c in best:
        sums[c] = sums.get(c, 0) + d
    return [(i, c, d, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, best)]


def spell(rows):
    return sorted(map(str, rows))


def compare(spark, rows, k, rounds=5, dims=4, partitions=5, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    found = [tuple(r) for r in hamerly.cluster(docs, k=k, rounds=rounds, dims=dims, **options).collect()]
    want = brute(rows, k, rounds, dims=dims)
    assert spell(found) == spell(want)
    return found


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 4)) * 3
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=4) * 0.4]) for i in range(400)]
    compare(spark, rows, 7)
    compare(spark, rows, 7, partitions=1)
    compare(spark, rows, 1)
    compare(spark, rows, 3, rounds=0)


def test_ties_repeated_rows_and_empty_clusters(spark):
    """Equal centroids, vectors half way between two, and a hot vector that is half of all rows."""
    rows = [(i, [0.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(100 + i, [float(i % 3), float(i % 2), 0.0, -1.0]) for i in range(60)]
    rows += [rows[0]] * 10 + [(None, [0.5, 0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5, 0.5])]
    compare(spark, rows, 12)


def test_who_takes_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (2, None), (3, []), (4, [1.0, 2.0, 3.0]), (5, [1.0, None, 3.0, 4.0]), (6, [nan] * 4), (7, [1.0, inf, 0.0, 0.0]), (8, [-1.5, 0.001, -0.001, 0.0])]
    found = compare(spark, rows, 40)
    assert {r[0] for r in found} == {1, 8}
    assert hamerly.cluster(spark.createDataFrame([(1, [3e38] * 4)], SCHEMA), dims=4).count() == 0
    empty = hamerly.cluster(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, [1.0] * 4, "mine", 5, 7)], "vec_id bigint, embedding array<float>, cluster string, `a.b` int, __v int")
    found = hamerly.cluster(docs, dims=4)
    assert found.columns[:3] == ["vec_id", "a.b", "__v"]
    assert tuple(found.first())[:5] == (1, 5, 7, 0, 0)
    assert hamerly.cluster(docs, dims=4, keep=["embedding"]).first()["embedding"] == [1.0] * 4


@pytest.mark.parametrize("top", [200, 2**26])
def test_distances_are_exact_in_both_number_kinds(top):
    rng = np.random.default_rng(1)
    v, p = (rng.integers(-top, top, size=(n, 64)) for n in (50, 9))
    assert (hamerly.distances(v, p) == ((v[:, None, :] - p[None, :, :]) ** 2).sum(axis=2)).all()


def test_bounds_spare_most_scans():
    """After the first round over clustered vectors nearly all are decided by their bounds; every assignment is the exact one."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, size=(20, 64))
    v = (centres[np.arange(5000) % 20] + rng.integers(-200, 200, size=(5000, 64))).astype(np.int64)
    points, before = v[:20].copy(), None
    state = np.full(5000, -1, np.int32), np.zeros(5000), np.zeros(5000)
    scans = []
    for _ in range(4):
        *state, scanned = hamerly.assign(v, hamerly.Centroids.of(points, before), *state)
        assert (state[0] == hamerly.distances(v, points).argmin(axis=1)).all()
        scans.append(scanned)
        before = points
        points = np.array([v[state[0] == c].sum(axis=0) // max((state[0] == c).sum(), 1) if (state[0] == c).any() else points[c] for c in range(20)])
    assert scans[0] == 5000 and max(scans[1:]) < 500, scans
