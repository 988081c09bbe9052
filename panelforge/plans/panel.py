"""Building the processed panel: one lazy plan from the wide file to Parquet."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from panelforge.operators.enrich import join_calendar, join_prices
from panelforge.operators.reshape import melt_days
from panelforge.sources import readers

FILES = {"calendar": "calendar.csv", "prices": "sell_prices.csv", "sales": "sales_train_validation.csv"}


def merged(sales_long: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    return join_prices(join_calendar(sales_long, calendar), prices)


def build_panel(spark: SparkSession, data_dir: str, output: str, *, day_range: tuple[int, int] | None = None, force: bool = False, files: dict[str, str] | None = None) -> str:
    """Write the merged panel; an output that was committed before is kept unless ``force``."""
    if not force and readers.is_complete(spark, output):
        return output
    names = FILES | (files or {})
    wide = readers.read_sales_wide(spark, f"{data_dir}/{names['sales']}", day_range)
    panel = merged(melt_days(wide), readers.read_calendar(spark, f"{data_dir}/{names['calendar']}"), readers.read_prices(spark, f"{data_dir}/{names['prices']}"))
    panel.write.mode("overwrite").parquet(output, compression="snappy")
    return output


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the demand panel from the three CSV files.")
    parser.add_argument("data_dir")
    parser.add_argument("output")
    parser.add_argument("--force", action="store_true", help="build again even if the output exists")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("panelforge").getOrCreate()
    print(build_panel(spark, options.data_dir, options.output, force=options.force))


if __name__ == "__main__":
    main()
