"""Joins of the long fact table to its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelforge.operators.reshape import lean

PRICE_KEY = ["store_id", "item_id", "wm_yr_wk"]


def join_calendar(long: DataFrame, calendar: DataFrame) -> DataFrame:
    """Left join on the day. The calendar has a row per day, so Spark broadcasts it by its size."""
    dim = lean(calendar)
    keys = [k for k in ("d", "d_int") if k in long.columns and k in dim.columns]
    return long.join(dim, keys, "left")


def join_prices(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on store, item and week; no hint, AQE picks the strategy and splits a hot key."""
    return panel.join(prices.select(*PRICE_KEY, "sell_price"), PRICE_KEY, "left")


def uncovered_prices(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Keys of the panel without a price."""
    return panel.select(*PRICE_KEY).distinct().join(prices.select(*PRICE_KEY), PRICE_KEY, "left_anti")


def repeated_keys(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that would fan a join out."""
    return dim.groupBy(*keys).count().where("count > 1")
