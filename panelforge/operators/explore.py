"""The exploratory aggregates, each a frame: what the plots and the summary show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions import schema as S
from panelforge.operators.quantiles import exact_quantiles
from panelforge.operators.sampling import smallest


def national_daily(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("sales").alias("sales"))


def state_daily(df: DataFrame) -> DataFrame:
    return df.groupBy("date", "state_id").agg(F.sum("sales").alias("sales"))


def mean_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg("sales").alias("mean_sales"))


def zero_rate(df: DataFrame) -> DataFrame:
    """Share of rows with no sale by store and category; a null counts as a row that isn't zero."""
    return df.groupBy("store_id", "cat_id").agg(F.avg(F.when(F.col("sales") == 0, 1.0).otherwise(0.0)).alias("zero_rate"))


def zero_rate_matrix(df: DataFrame, categories: list[str]) -> DataFrame:
    """A row per store, a column per stated category."""
    return zero_rate(df).groupBy("store_id").pivot("cat_id", categories).agg(F.first("zero_rate"))


def median_by_category(df: DataFrame) -> DataFrame:
    return exact_quantiles(df.where("sales > 0"), "sales", [0.5], ["cat_id"]).withColumnRenamed("q0", "median_sales").orderBy(F.desc("median_sales"), "cat_id")


def snap_effect(df: DataFrame) -> DataFrame:
    """Mean sales with and without the flag, each state by its own."""
    rows = None
    for s in S.STATES:
        flag = F.col(f"snap_{s}")
        one = df.where(F.col("state_id") == s).groupBy("state_id").agg(F.avg(F.when(flag == 1, F.col("sales"))).alias("snap_mean"), F.avg(F.when(flag == 0, F.col("sales"))).alias("other_mean"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Exact, with linear interpolation."""
    return exact_quantiles(df, column, [q]).withColumnRenamed("q0", "q")


def histogram(df: DataFrame, column: str = "sales", bins: int = 80) -> DataFrame:
    """(bin, low, n) of the positive values in equal bins; the last is closed. Bins without values are there with 0."""
    values = df.where(F.col(column) > 0).select(F.col(column).cast("double").alias("x"))
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("lo")) / width)))
    counts = values.crossJoin(F.broadcast(ends)).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = ends.where("lo is not null").select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return every.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), F.coalesce("n", F.lit(0)).alias("n"))


def box_stats(df: DataFrame) -> DataFrame:
    """Quartiles and whiskers (the furthest values within 1.5 interquartile ranges) of positive sales by category."""
    values = df.where("sales > 0").select("cat_id", F.col("sales").cast("double").alias("x"))
    q = exact_quantiles(values, "x", [0.25, 0.5, 0.75], ["cat_id"]).toDF("cat_id", "q1", "median", "q3")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = values.join(q, "cat_id").where((F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach))
    whiskers = inside.groupBy("cat_id").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    return q.join(whiskers, "cat_id")


def price_elasticity(df: DataFrame) -> DataFrame:
    """Least squares of log1p(sales) on log1p(price) by category, over sales above 0 with a price."""
    used = df.dropna(subset=["sell_price"]).where("sales > 0").select("cat_id", F.log1p("sales").alias("y"), F.log1p("sell_price").alias("x"))
    return used.groupBy("cat_id").agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.regr_count("y", "x").alias("n"))


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = S.SEED) -> DataFrame:
    """Exactly min(n, rows) rows, the same for the same seed: those with the smallest md5 of seed and keys. ``keys`` should
    tell rows apart; which of rows that agree in all of them are taken is left open."""
    return smallest(df, n, F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary")))


def price_report(prices: DataFrame) -> DataFrame:
    """Median, least, largest price and the number of stores, in one row."""
    ends = prices.agg(F.min("sell_price").alias("low"), F.max("sell_price").alias("high"), F.count_distinct("store_id").alias("stores"))
    return quantile(prices, "sell_price", 0.5).withColumnRenamed("q", "median").crossJoin(F.broadcast(ends))


def summary(df: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Eleven figures of the three tables, in one row."""
    panel = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("series"),
        F.count_distinct("store_id").alias("stores"),
        F.count_distinct("state_id").alias("states"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        (F.avg(F.when(F.col("sales") == 0, 1.0).otherwise(0.0)) * 100).alias("zero_pct"),
        F.avg("sales").alias("mean_sales"),
    )
    days = calendar.agg(F.count(F.lit(1)).alias("calendar_rows"))
    price = prices.agg(F.count(F.lit(1)).alias("price_rows"), F.max("sell_price").cast("double").alias("max_price"))
    median = quantile(prices, "sell_price", 0.5).withColumnRenamed("q", "median_price")
    for one_row in (days, price, median):
        panel = panel.crossJoin(F.broadcast(one_row))
    return panel
