"""The driver's star schema as a demand panel: series are part types by supplier nation, over a dense run of days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First day (of the given tables' shipments, and of week 11101), number of days, and the invented events (month-day, name, type).
FIRST_DATE, DAYS = "1995-01-02", 2499
EVENTS_1 = [("01-01", "NewYear", "National"), ("02-14", "Valentines", "Cultural"), ("07-04", "Independence", "National"), ("10-31", "Halloween", "Cultural"), ("12-25", "Christmas", "National")]
EVENTS_2 = [("12-25", "Gift", "Cultural"), ("01-01", "Parade", "Cultural")]
#: Regions that play the three states, with the first day of month of their ten flagged days.
REGION_OF = {"CA": ("AMERICA", 1), "TX": ("ASIA", 5), "WI": ("EUROPE", 9)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each day from the first to the last shipment, numbered from 1."""
    shipped = F.to_date("l_shipdate")
    ends = table(spark, sf_dir, "lineitem").agg(F.min(shipped).alias("first"), F.max(shipped).alias("last")).where("first is not null")
    days = ends.select("first", F.explode(F.sequence("first", "last")).alias("date")).select((F.datediff("date", "first") + 1).cast("smallint").alias("d_int"), "date")
    md = F.date_format("date", "MM-dd")

    def event(table: list[tuple[str, str, str]], at: int):
        out = F.lit(None).cast("string")
        for day, *values in table:
            out = F.when(md == day, F.lit(values[at])).otherwise(out)
        return out

    flag = lambda first: F.dayofmonth("date").between(first, first + 9).cast("tinyint")
    return days.select(
        "date",
        (11101 + F.floor((F.col("d_int") - 1) / 7)).cast("smallint").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.dayofweek("date") % 7 + 1).cast("tinyint").alias("wday"),
        F.month("date").cast("tinyint").alias("month"),
        F.year("date").cast("smallint").alias("year"),
        F.concat(F.lit("d_"), F.col("d_int").cast("string")).alias("d"),
        event(EVENTS_1, 0).alias("event_name_1"),
        event(EVENTS_1, 1).alias("event_type_1"),
        event(EVENTS_2, 0).alias("event_name_2"),
        event(EVENTS_2, 1).alias("event_type_2"),
        *[flag(first).alias(f"snap_{s}") for s, (_, first) in REGION_OF.items()],
        "d_int",
    )


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with item, store and state; the dimensions are broadcast if Spark sees that they are small."""
    state = F.lit(None).cast("string")
    for s, (region, _) in REGION_OF.items():
        state = F.when(F.col("r_name") == region, F.lit(s)).otherwise(state)
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("p_type").alias("item_id"), F.col("n_name").alias("store_id"), F.coalesce(state, "r_name").alias("state_id"), F.to_date("l_shipdate").alias("date"), "l_quantity", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    )


def sales_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = sold(spark, sf_dir).select("item_id", "store_id", "state_id").distinct()
    sized = F.when(F.col("item_id").isin("SMALL", "MEDIUM", "LARGE"), "SIZED").otherwise("TIERED")
    return ids.select(F.concat_ws("_", "item_id", "store_id").alias("id"), "item_id", F.col("item_id").alias("dept_id"), sized.alias("cat_id"), "store_id", "state_id")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = (11101 + F.floor(F.datediff("date", F.lit(FIRST_DATE).cast("date")) / 7)).cast("smallint")
    return sold(spark, sf_dir).groupBy("store_id", "item_id", week.alias("wm_yr_wk")).agg(F.max("unit").cast("float").alias("sell_price"))


def sales_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids, d, d_int, sales for every series and day; days without a sale are 0."""
    daily = sold(spark, sf_dir).groupBy("item_id", "store_id", "date").agg(F.sum("l_quantity").alias("q"))
    spine = sales_meta(spark, sf_dir).crossJoin(calendar(spark, sf_dir).select("d", "d_int", "date"))
    return spine.join(daily, ["item_id", "store_id", "date"], "left").select(
        "id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "d_int", F.coalesce("q", F.lit(0.0)).cast("float").alias("sales")
    )
