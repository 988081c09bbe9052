"""Types, column sets and constants of the demand panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Columns of the three sources and of the merged panel.
ID_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
EVENT_COLUMNS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
STATES = ["CA", "TX", "WI"]
SNAP_COLUMNS = [f"snap_{s}" for s in STATES]
CALENDAR_COLUMNS = ["d", "d_int", "date", "wm_yr_wk", "weekday", "wday", "month", "year", *EVENT_COLUMNS, *SNAP_COLUMNS]
ENCODED_COLUMNS = ["item_id", "dept_id", "cat_id", "store_id", "state_id", "event_type_1", "event_type_2", "weekday"]

# Horizon, days and feature settings.
HORIZON = 28
LAST_DAY = 1913
LAGS = (28, 29, 30, 35, 42, 56)
WINDOWS = (7, 14, 28, 56)
STATS = ("mean", "std", "min", "max")
SPLITS = {"train": (1, 1800), "valid": (1801, 1856), "test": (1857, 1913)}
SEED = 42

# What cleaning puts in place of nulls.
NO_EVENT, UNKNOWN, WEEKDAY = "No_Event", "Unknown", "Monday"
WDAY, MONTH, YEAR, WEEK = 1, 1, 2011, 11101
PRICE_FALLBACK, PRICE_CAP, PRICE_FLOOR = 1.0, 0.9999, 0.01
NAN_WORDS = ["nan", "NaN", "None", "<NA>", ""]

# What the checks expect of the full data.
SERIES, CALENDAR_ROWS = 30_490, 1_969
REQUIRED = {
    "calendar": ["date", "d", "wm_yr_wk", "wday", "month", "year", *SNAP_COLUMNS],
    "prices": ["store_id", "item_id", "wm_yr_wk", "sell_price"],
    "sales_meta": ID_COLUMNS,
    "processed_long": [*ID_COLUMNS, "d", "sales", "date", "wm_yr_wk", "sell_price"],
    "features": [*ID_COLUMNS, "d_int", "date", "sales", "sell_price", "wday", "month", "year", "wm_yr_wk", "event_name_1", "event_type_1", *SNAP_COLUMNS],
}


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


CALENDAR = _fields(
    date=T.DateType(), wm_yr_wk=T.ShortType(), weekday=T.StringType(), wday=T.ByteType(), month=T.ByteType(), year=T.ShortType(), d=T.StringType(),
    **{c: T.StringType() for c in EVENT_COLUMNS}, **{c: T.ByteType() for c in SNAP_COLUMNS},
)
PRICES = _fields(store_id=T.StringType(), item_id=T.StringType(), wm_yr_wk=T.ShortType(), sell_price=T.FloatType())


def day_columns(first: int = 1, last: int = LAST_DAY) -> list[str]:
    """Names of the wide table's day columns, both ends included."""
    return [f"d_{n}" for n in range(first, last + 1)]


def sales_wide(first: int = 1, last: int = LAST_DAY) -> T.StructType:
    return _fields(**{c: T.StringType() for c in ID_COLUMNS}, **{c: T.FloatType() for c in day_columns(first, last)})


@dataclass(frozen=True)
class FeatureConfig:
    """Lags are at least the horizon, so that no feature sees the days to forecast; 28 is needed by the windows."""

    lags: tuple[int, ...] = LAGS
    windows: tuple[int, ...] = WINDOWS
    stats: tuple[str, ...] = STATS
    encoded: tuple[str, ...] = tuple(ENCODED_COLUMNS)
    horizon: int = HORIZON

    def __post_init__(self) -> None:
        if bad := [n for n in self.lags if n < self.horizon]:
            raise ValueError(f"lags below the horizon of {self.horizon} days leak: {bad}")
        if self.windows and self.horizon not in self.lags:
            raise ValueError(f"rolling features need the lag of {self.horizon} days")
        if unknown := set(self.stats) - set(STATS):
            raise ValueError(f"unknown statistics: {sorted(unknown)}")
