"""Exact quantiles and samples by counting, against plain sorting; what the largest task reads."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from panelforge.operators import explore
from panelforge.operators.quantiles import exact_quantiles
from panelforge.operators.sampling import smallest


def plain(values, q):
    values = sorted(values)
    place = q * (len(values) - 1)
    low = int(place)
    high = low + (place > low)
    return values[low] if low == high else (high - place) * values[low] + (place - low) * values[high]


def largest_read(spark, work):
    """(result, most rows that one task read from a shuffle) of ``work()``."""
    sc = spark.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "measured")
    try:
        result = work()
    finally:
        sc.setJobGroup("", "")
    store, tracker = sc._jsc.sc().statusStore(), sc.statusTracker()
    most = 0
    for job in tracker.getJobIdsForGroup(group):
        for stage in tracker.getJobInfo(job).stageIds:
            try:
                tasks = store.taskList(stage, 0, 10_000)
            except Exception:  # a skipped stage
                continue
            for i in range(tasks.size()):
                metrics = tasks.apply(i).taskMetrics()
                if metrics.isDefined():
                    most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return result, most


@pytest.mark.parametrize("spread", ["even", "few values", "skewed", "one", "signs", "infinite"])
def test_quantiles_against_sorting(spark, spread):
    rng = random.Random(spread)
    make = {
        "even": lambda: rng.random(),
        "few values": lambda: float(rng.randint(0, 3)),
        "skewed": lambda: 2.0 ** rng.randint(-300, 300),
        "one": lambda: 4.25,
        "signs": lambda: rng.gauss(0, 1e6),
        "infinite": lambda: rng.choice([float("inf"), float("-inf"), 1.0, 2.5, -3.0]),
    }[spread]
    values = [make() for _ in range(2001)]
    qs = [0.0, 0.25, 0.5, 0.9999, 1.0]
    df = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "x double").repartition(5)
    for options in ({}, {"ranges": 2, "levels": 3}, {"levels": 0}):
        assert list(exact_quantiles(df, "x", qs, **options).first()) == pytest.approx([plain(values, q) for q in qs], nan_ok=True)


def test_quantiles_by_group(spark):
    rng = random.Random(1)
    rows = [("hot", rng.random()) for _ in range(3000)] + [(None, 1.0), (None, 2.0), ("one", 7.0), ("none", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "`a.g` string, x float")
    found = {r[0]: (r.q0, r.q1) for r in exact_quantiles(df, "x", [0.5, 0.99], ["a.g"]).collect()}
    single = [r[0] for r in df.where("`a.g` = 'hot'").select(F.col("x").cast("double")).collect()]
    assert found == {"hot": pytest.approx((plain(single, 0.5), plain(single, 0.99))), None: pytest.approx((1.5, 1.99)), "one": (7.0, 7.0)}
    assert exact_quantiles(df, "x", [0.5, 0.99], ["a.g"]).columns == ["a.g", "q0", "q1"]


def test_groups_beyond_the_broadcast_limit_agree(spark, monkeypatch):
    from panelforge.operators import quantiles

    df = spark.range(600).select((F.col("id") % 40).alias("g"), (F.col("id") * 7 % 101).cast("double").alias("x"))
    want = sorted(map(tuple, exact_quantiles(df, "x", [0.3], ["g"]).collect()))
    monkeypatch.setattr(quantiles, "GROUPS", 5)
    assert sorted(map(tuple, exact_quantiles(df, "x", [0.3], ["g"]).collect())) == want


def test_empty_tables(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert tuple(exact_quantiles(df, "x", [0.5, 0.1]).first()) == (None, None)
    assert exact_quantiles(df, "x", [0.5], ["g"]).count() == 0
    assert explore.box_stats(spark.createDataFrame([], "cat_id string, sales double")).count() == 0


def test_five_million_distinct_prices_meet_in_no_task(spark):
    n = 5_000_000
    df = spark.range(0, n, numPartitions=16).select(((F.col("id") * 2_654_435_761) % 5_000_011 + F.col("id") / (4.0 * n)).alias("x"))
    (row, most) = largest_read(spark, lambda: exact_quantiles(df, "x", [0.5, 0.9999]).first())
    assert list(row) == pytest.approx(list(df.agg(F.percentile("x", F.array(F.lit(0.5), F.lit(0.9999)))).first()[0]))
    assert 0 < most <= 16 * 4 * 4096  # counts of ranges, not values


def test_sample_takes_the_smallest_hashes(spark):
    df = spark.range(0, 30_000, numPartitions=7).select(F.col("id"), F.md5(F.col("id").cast("string").cast("binary")).alias("h"))
    everything = [r.id for r in df.orderBy("h").collect()]
    for n in (0, 1, 777, 29_999, 30_000, 40_000):
        assert {r.id for r in smallest(df, n, F.col("h")).collect()} == set(everything[:n])


def test_sample_of_rows_that_share_their_keys(spark, monkeypatch):
    from panelforge.operators import sampling

    monkeypatch.setattr(sampling, "FEW", 50)
    df = spark.createDataFrame([(None, i) for i in range(900)] + [(str(i), i) for i in range(100)], "k string, v int").repartition(3)
    found = explore.seeded_sample(df, 500, ["k"]).collect()
    assert len(found) == 500 and len({(r.k, r.v) for r in found}) == 500


def test_a_large_sample_meets_in_no_task(spark):
    df = spark.range(0, 1_000_000, numPartitions=8).select(F.col("id").alias("k"))
    found, most = largest_read(spark, lambda: explore.seeded_sample(df, 200_000, ["k"]).agg(F.count("*"), F.count_distinct("k")).first())
    assert tuple(found) == (200_000, 200_000)
    plan = explore.seeded_sample(df, 200_000, ["k"])
    assert max(plan.rdd.glom().map(len).collect()) < 40_000
