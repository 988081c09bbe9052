"""Groups of near-duplicate candidates that do not link: exact, and without all pairs."""

import random

import numpy as np
import pytest
from test_structure_operators import brute_components

from panelforge.llm import minhash


def template_pages(n, rng, own=40, shared=200):
    template = [f"t{i}" for i in range(shared)]
    return [" ".join(template + [f"o{rng.getrandbits(40)}" for _ in range(own)]) for _ in range(n)]


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_prefix(percent):
    rng = np.random.default_rng(percent)
    common = np.unique(rng.integers(0, 400, 150).astype("<u8"))
    ranks = rng.integers(2, 60, len(common))
    linked = 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 120)).astype("<u8"))
        b = np.unique(np.append(rng.permutation(a)[: max(1, len(a) - rng.integers(0, 1 + len(a) // 5))], rng.integers(0, 400, rng.integers(0, 1 + len(a) // 8)).astype("<u8")))
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            linked += 1
            assert len(np.intersect1d(minhash.prefix(a, common, ranks, percent), minhash.prefix(b, common, ranks, percent)))
    assert linked > 50


def compared(spark, monkeypatch, texts, **options):
    """(component of each document, sets sent to the exact comparison)."""
    sent = []
    whole = minhash._with_sets

    def counting(dealt, sets, group, order=()):
        if group == ["leader", "low", "high"]:
            sent.append(dealt.count())
        return whole(dealt, sets, group, order)

    monkeypatch.setattr(minhash, "_with_sets", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, **options).collect()}
    monkeypatch.undo()
    return found, sum(sent)


def test_template_pages_cost_in_proportion(spark, monkeypatch):
    costs = []
    for n in (250, 500, 1000):
        found, sent = compared(spark, monkeypatch, template_pages(n, random.Random(n)), block_sets=32)
        assert all(k == c for k, c in found.items())
        costs.append(sent)
    assert costs[1] <= 2 * costs[0] + 50 and costs[2] <= 2 * costs[1] + 50, costs


def test_clusters_within_a_template_are_found(spark, monkeypatch):
    """Small groups of near copies, and single pages, among pages that share a template but do not link."""
    rng = random.Random(9)
    texts = template_pages(120, rng)
    for at in range(0, 60, 5):
        base = texts[at].split()
        for k in range(rng.randint(1, 4)):
            copy = list(base)
            copy[rng.randrange(200, 240)] = f"edited{at}x{k}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    found, _ = compared(spark, monkeypatch, texts, block_sets=16)
    assert found == brute_components(list(enumerate(texts)), 80)
