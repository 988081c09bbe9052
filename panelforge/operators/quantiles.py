"""Exact quantiles by counting: no task holds a column's distinct values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a level counts, and about how many values are then left to be counted one by one.
RANGES, LEFT = 4096, 100_000
#: Up to this many groups, their ends are broadcast, else they are joined.
GROUPS = 10_000


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float], by: Sequence[str] = (), *, ranges: int = RANGES, levels: int | None = None) -> DataFrame:
    """(``by``..., q0, q1, ...): quantiles of ``column`` as doubles, with linear interpolation, in each group of ``by``.

    A first pass takes each group's count, minimum and maximum. Each level cuts what lies between a group's bounds into
    ``ranges`` equal ranges and counts them; the range that holds a wanted rank gives that rank's new bounds, its
    own minimum and maximum. In the end only values within the last bounds are counted each, about the group's rows
    over ranges ** levels of them; by default there are as many levels as leave few. Counts are partial before they are
    shuffled, so a group or a value may hold most of the rows. How values are spread decides how far a level narrows,
    never the result.

    Nulls and NaN don't count. A group without values, and an empty table with ``by``, give no row; without ``by``
    there is one row of nulls. A null in ``by`` is a group.
    """
    keys = [f"k{i}" for i in range(len(by))]
    x = F.col(f"`{column}`").cast("double")
    values = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)], x.alias("x")).where(x.isNotNull() & ~F.isnan(x))
    ends = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).where("n > 0")
    known = ends.limit(GROUPS + 1).collect()
    few = len(known) <= GROUPS
    if few:  # counted once
        ends = df.sparkSession.createDataFrame(known, ends.schema)
    if levels is None:
        most = max((r.n for r in known), default=0) if few else ends.agg(F.max("n")).first()[0]
        levels = max(0, math.ceil(math.log(max(most, 1) / LEFT, ranges)))
    place = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    wanted = F.array_distinct(F.array(*[side(place(q)).cast("long") for q in qs for side in (F.floor, F.ceil)]))
    ranks = ends.select(*keys, "n", "low", "high", F.explode(wanted).alias("wanted")).withColumn("rank", F.col("wanted"))
    for _ in range(levels):
        counted = _within(values, ranks, keys, few, _range(ranges)).agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("new_low"), F.max("x").alias("new_high"))
        ranks = _place(counted, ranks, keys, few).select(*keys, "n", F.col("new_low").alias("low"), F.col("new_high").alias("high"), "wanted", "rank")
    found = _place(_within(values, ranks, keys, few, F.col("x")).agg(F.count(F.lit(1)).alias("c")), ranks, keys, few)
    found = found.groupBy(*keys).agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("wanted", "at"))).alias("held"))  # two a quantile
    out = found.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *[_interpolated(place(q)).alias(f"q{i}") for i, q in enumerate(qs)])
    return out if by else out.agg(*[F.max(f"q{i}").alias(f"q{i}") for i in range(len(qs))])


def _range(ranges: int) -> Column:
    """The range of x between low and high, rising with x; the highest value is in the last one, infinite ones too."""
    part = F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * ranges)
    return F.when(F.col("x") == F.col("high"), ranges - 1).otherwise(F.least(F.greatest(part, F.lit(0)), F.lit(ranges - 1))).cast("int")


def _within(values: DataFrame, ranks: DataFrame, keys: list[str], few: bool, at: Column):
    """The values between any bounds, grouped by these and ``at``. Groups have two bounds a quantile at most."""
    bounds = ranks.select(*[F.col(k).alias(f"b{k}") for k in keys], "low", "high").distinct()
    same = [F.col(k).eqNullSafe(F.col(f"b{k}")) for k in keys]
    inside = (F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high"))
    for s in same:
        inside = s & inside
    return values.join(F.broadcast(bounds) if few else bounds, inside).select(*keys, "low", "high", "x", at.alias("at")).groupBy(*keys, "low", "high", "at")


def _place(counted: DataFrame, ranks: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """``ranks`` with the counted row that holds each, and their place within it."""
    within = Window.partitionBy(*keys, "low", "high").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("upto", F.sum("c").over(within)).select(*[F.col(k).alias(f"b{k}") for k in keys], F.col("low").alias("blow"), F.col("high").alias("bhigh"), *[c for c in counted.columns if c not in (*keys, "low", "high")], "upto")
    same = (F.col("low") == F.col("blow")) & (F.col("high") == F.col("bhigh")) & (F.col("rank") >= F.col("upto") - F.col("c")) & (F.col("rank") < F.col("upto"))
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"b{k}")) & same
    return upto.join(F.broadcast(ranks) if few else ranks, same).withColumn("rank", F.col("rank") - (F.col("upto") - F.col("c")))


def _interpolated(place: Column) -> Column:
    low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
    value = lambda rank: F.element_at("held", rank)
    return F.when(low == high, value(low)).otherwise((high - place) * value(low) + (place - low) * value(high))
