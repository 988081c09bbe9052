"""Large groups of near-duplicate candidates: exact, and in few Spark jobs, as each costs a task a partition."""

import random

import numpy as np
import pandas as pd
import pytest
from test_prefixes import template_pages
from test_structure_operators import brute_components

from panelforge.llm import minhash


def near_copies(n, rng, words=120, edits=2):
    """Copies of a base that is not among them, most not linked with the first one."""
    base = [f"b{i}" for i in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{k}x{rng.getrandbits(20)}"
        out.append(" ".join(copy))
    return out


def test_large_groups_take_few_jobs(spark):
    rng = random.Random(3)
    texts = template_pages(150, rng)
    for at in range(0, 60, 6):
        copy = texts[at].split()
        copy[rng.randrange(200, 240)] = f"edited{at}"
        texts.append(" ".join(copy))
    copies = near_copies(150, rng, edits=4)
    copies[0] = " ".join(copies[0].split()[:108] + [f"far{i}" for i in range(12)])
    docs = spark.createDataFrame(list(enumerate(copies + texts)), "doc_id bigint, text string").repartition(4)
    spark.sparkContext.setJobGroup("large groups", "")
    try:
        found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, percent=85, block_sets=24).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("large groups"))
    assert found == brute_components(list(enumerate(copies + texts)), 85)
    assert jobs <= 130, jobs


@pytest.mark.parametrize("percent", [80, 85])
def test_rows_of_one_id_in_a_large_group(spark, percent):
    """An id with two texts joins what either is linked with, also where only one of them is in the largest component."""
    rng = random.Random(percent)
    texts = near_copies(60, rng, edits=3) + template_pages(40, rng)
    rows = list(enumerate(texts)) + [(5, texts[70]), (64, texts[10]), (80, texts[81] + " more"), (None, texts[3])]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), percent=percent, block_sets=10).collect()
    want = brute_components([r for r in rows if r[0] is not None], percent)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == want and len(out) == len(rows)


def test_pivots_cover_the_sample():
    rng = np.random.default_rng(1)
    bases = [rng.integers(0, 2**62, 200).astype("<u8") for _ in range(3)]
    lone = rng.integers(0, 2**62, 200).astype("<u8")
    sets = [np.unique(lone)] + [np.unique(np.append(bases[k % 3][rng.permutation(200)[:195]], rng.integers(0, 2**62, 3).astype("<u8"))) for k in range(40)]
    chosen, labels, joined = minhash.pivots(sets, 85)
    assert chosen[0] == 0 and len(chosen) == 4 and labels == [0, 1, 2, 3] and len(joined) == 37


def test_largest_component_of_masks():
    rows = pd.DataFrame({"leader": [7] * 6, "mask": [0, 1, 2, 4, 8, 12], "count": [50, 9, 20, 10, 14, 1]})
    assert minhash._largest(rows).values.tolist() == [[7, 12, 79]]
