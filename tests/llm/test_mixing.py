"""Source mixing against water-filling by rounds, and its thresholds on hot, tied and empty inputs."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, source string, text string"


def brute_targets(sizes: dict, weights=(1, 2, 3), share=1.0, most=3) -> dict:
    """By rounds: share out, cut at the limits, share out again what was cut off."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not full:
            for s in free:
                target[s] = level * weight[s]
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


def check(rows, found, **options):
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, source, text in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    want = brute_targets(sizes, **options)
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.repeats * r["size"] and 0 <= r.repeats <= options.get("most", 3)
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest[s] / 2 + 1e-6, s
    return want


def test_targets_and_takes_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        source = rng.choice(["a", "b", "Z", "é", "😀", None, "a b", ""]) if i % 3 else "hot"
        rows.append((i, source, " ".join("w" * rng.randint(1, 4) for _ in range(int(rng.paretovariate(1.1))))))
    rows += [(9000 + i, "words none", "  \t\n") for i in range(5)] + [(9100, "tiny", "one"), (9101, "tiny", None), (9102, "a", None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = mixing.mix(docs).collect()
    check(rows, found)
    for options in ({"share": 2.5}, {"share": 3.0}, {"weights": (5,), "most": 1, "share": 0.4}):
        check(rows, mixing.mix(docs, **options).collect(), **options)


def test_no_break_space_is_no_white_space(spark):
    docs = spark.createDataFrame([(1, "s", "a b c\x0bd\x1ce")], SCHEMA)
    assert mixing.mix(docs).first()["size"] == 3


def test_reruns_and_partitions_agree(spark):
    rows = [(i, f"s{i % 5}", "x " * (1 + i % 17)) for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    results = [sorted(tuple(r) for r in mixing.mix(docs.repartition(n), keep=["doc_id"]).collect()) for n in (1, 5, 16)]
    assert results[0] == results[1] == results[2]


def test_equal_and_id_less_rows_are_told_apart(spark):
    """A third of the rows share one null id, a third one id with different texts, some of them equal."""
    rows = [(None, "hot", "five words are in here")] * 600 + [(7, "hot", "t " * (1 + i % 40)) for i in range(600)] + [(i, "other", "o " * 30) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = [mixing.mix(docs.repartition(n), weights={"hot": 1, "other": 3}).collect() for n in (2, 9)]
    sizes = {"hot": 600 * 5 + sum(1 + i % 40 for i in range(600)), "other": 600 * 30}
    for rows_found in found:
        for source, part in (("hot", 0.25), ("other", 0.75)):
            mine = [r for r in rows_found if r.source == source]
            assert mine[0].target == pytest.approx(part * sum(sizes.values()))
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20
    a, b = (sorted((str(r.doc_id), r.text, r.taken) for r in rows_found) for rows_found in found)
    assert a == b


def test_thresholds_are_nested(spark):
    rows = [(i, f"s{i % 2}", "x " * (1 + i % 9)) for i in range(1000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    less, more = ({r.doc_id: r.repeats for r in mixing.mix(docs, weights={"s0": 1, "s1": w}).collect()} for w in (2, 3))
    assert all(less[i] <= more[i] for i in range(1, 1000, 2)) and sum(less.values()) and less != more


def test_mapped_weights_null_source_and_unnamed_sources(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, None, "x y"), (3, "b", "x y")], SCHEMA)
    found = {r.source: (r.target, r.taken) for r in mixing.mix(docs, weights={"a": 1, None: 2}).collect()}
    assert found == {"a": (2.0, 2), None: (4.0, 4), "b": (0.0, 0)}


def test_empty_tables_no_words_and_clashing_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    out = mixing.mix(docs)
    assert out.columns == ["doc_id", "source", "text", *mixing.ADDED] and out.count() == 0
    blank = spark.createDataFrame([(1, None, None), (None, "a", " ")], SCHEMA)
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2
    clash = spark.createDataFrame([(1, "a", "x y")], SCHEMA).withColumn("size", F.lit("mine")).withColumn("target", F.lit(True)).withColumn("a.b", F.lit(5)).withColumn("__key", F.lit(1))
    found = mixing.mix(clash)
    assert sorted(found.columns) == sorted(["doc_id", "source", "text", "a.b", "__key", *mixing.ADDED])
    assert found.first()["size"] == 2 and found.first()["a.b"] == 5


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "a", "word " * 1_000_000), (2, "b", "one")], SCHEMA)
    assert {r.doc_id: r["size"] for r in mixing.mix(docs, keep=["doc_id"]).collect()} == {1: 1_000_000, 2: 1}


def test_no_python_runs(spark):
    plan = mixing.mix(spark.createDataFrame([(1, "a", "x")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
