"""The cover tree's invariants at the shipped leaf size, pruning, and exact integer scores."""

import numpy as np
import pytest

from panelforge.llm import covertree


def clustered(n, clusters, width=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-4000, 4000, (clusters, width))
    return centres[np.arange(n) % clusters] + rng.integers(-60, 60, (n, width))


@pytest.mark.parametrize("x", [clustered(4000, 40), np.random.default_rng(1).integers(-128, 128, (3000, 64)), np.zeros((700, 3), np.int64)])
def test_covering_separation_and_nesting(x):
    tree = covertree.CoverTree.build(x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    apart = lambda a, b: np.sqrt(((x[a].astype(float) - x[b]) ** 2).sum(axis=-1))
    for node, children in enumerate(tree.children):
        some = tree.order[tree.first[node] : tree.last[node]]
        assert tree.centre[node] in some
        assert apart(some, tree.centre[node]).max() <= min(tree.radius[node] + 1e-6, tree.cover(tree.level[node]) + 1e-6)
        if not children:
            assert len(some) <= covertree.LEAF or tree.radius[node] == 0
            continue
        assert tree.centre[children[0]] == tree.centre[node] and len(children) > 1
        assert [tree.first[node], *[tree.last[c] for c in children]] == [*[tree.first[c] for c in children], tree.last[node]]
        centres = [tree.centre[c] for c in children]
        assert all(apart(centres[i], centres[j]) > tree.cover(tree.level[node] + 1) for i in range(len(centres)) for j in range(i))
        assert all(tree.level[c] > tree.level[node] for c in children)
    again = covertree.CoverTree.unpacked(x, **tree.packed())
    assert (again.first, again.radius, again.children, again.top) == (tree.first, tree.radius, tree.children, tree.top)


def test_pruning_at_the_shipped_leaf_size():
    x = clustered(8000, 20)
    ids = np.arange(len(x))
    tree, queries = covertree.CoverTree.build(x), covertree.CoverTree.build(x[:2000])
    top = covertree.TopK(2000, 5)
    scored = covertree.dual_search(queries, ids[:2000], tree, ids, top)
    leaves = [sum(not c for c in t.children) for t in (queries, tree)]
    assert scored < leaves[0] * leaves[1] / 2, (scored, leaves)
    brute = x[:2000] @ x.T
    brute[np.arange(2000), np.arange(2000)] = covertree.NONE
    assert (np.sort(brute, axis=1)[:, ::-1][:, :5] == top.score).all()


def test_block_pairs_are_pruned_before_data_moves(spark, monkeypatch):
    moved = []
    plain = covertree._met
    monkeypatch.setattr(covertree, "_met", lambda pairs, *a: moved.append(pairs.count()) or plain(pairs, *a))
    x = clustered(3000, 12, width=4)
    frame = spark.createDataFrame([(i, [int(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, v array<bigint>")
    got = covertree.search(frame, frame.where("vec_id % 50 = 0"), query_block=40, candidate_block=250).collect()
    assert len(got) == 300 and moved[1] < 3 * moved[0]
    brute = x[::50] @ x.T
    for r in got:
        row = brute[r.query_id // 50].copy()
        row[r.query_id] = covertree.NONE
        assert np.sort(row)[::-1][r["rank"] - 1] == r.score


def test_scores_beyond_doubles_are_exact(spark):
    big = 2**30 + 1
    rows = [(0, [big, 1]), (1, [big, 1]), (2, [big, 2]), (3, [big, 3])]
    got = covertree.search(*[spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")] * 2)
    assert {(r.query_id, r["rank"]): r.score for r in got.collect()}[0, 1] == big * big + 3
    with pytest.raises(OverflowError):
        covertree.products(np.array([[2**32]]), np.array([[2**32]]))


def test_a_very_common_vector(spark):
    rows = [(i, [5, 5] if i % 3 else [i, 1]) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    got = covertree.search(frame, frame.where("vec_id = 1"), candidate_block=100)
    assert {(r["rank"], r.vec_id) for r in got.collect()} == {(1, 897), (2, 894), (3, 891), (4, 888), (5, 885)}
