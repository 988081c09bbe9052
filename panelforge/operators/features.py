"""Lag, rolling, calendar, price and code features, without leaking the forecast horizon."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import schema as S
from panelforge.functions.scalars import by_series, last_rows, safe_divide
from panelforge.operators.clean import NullsGiven, stage_without_nulls
from panelforge.sources.staging import Staging

PRICE_LAG, PRICE_ROWS = 7, 28

# What each builder of this module makes (patterns of whole names), under the group that a store's manifest lists it in.
MAKES = {
    "lag_features": ["sales_lag_.*"],
    "rolling_features": ["rolling_.*"],
    "calendar_features": [
        "day_of_year", "quarter", "is_weekend", "is_month_start", "is_month_end", "is_year_start", "is_year_end",
        "has_event", "has_event_2", "is_snap_day", "days_since_event",
    ],
    "price_features": ["price_.*", "is_price_promo"],
    "label_encoded": [".*_enc"],
}


@dataclass
class Features:
    """``df`` reads tables in the shared folder, which stay until ``release``."""

    df: DataFrame
    names: list[str]
    codes: DataFrame
    staging: Staging

    def release(self) -> None:
        self.staging.release()


def lag_features(lags=S.LAGS) -> dict[str, Column]:
    return {f"sales_lag_{n}": F.coalesce(F.lag("sales", n).over(by_series()), F.lit(0)).cast("float") for n in lags}


def rolling_features(windows=S.WINDOWS, stats=S.STATS, base: str = f"sales_lag_{S.HORIZON}") -> dict[str, Column]:
    """Over the zero-filled lag, the current row included; a single row has deviation 0."""
    made = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return {f"rolling_{s}_{w}d": F.coalesce(made[s](base).over(last_rows(w)), F.lit(0)).cast("float") for w in windows for s in stats}


def calendar_features() -> dict[str, Column]:
    flag = lambda c: c.cast("tinyint")
    day, month = F.dayofmonth("date"), F.col("month")
    return {
        "day_of_year": F.dayofyear("date").cast("smallint"),
        "quarter": F.quarter("date").cast("tinyint"),
        "is_weekend": flag(F.col("wday").isin(1, 2)),
        "is_month_start": flag(day <= 3),
        "is_month_end": flag(day >= 28),
        "is_year_start": flag((month == 1) & (day <= 7)),
        "is_year_end": flag((month == 12) & (day >= 25)),
    }


def event_flags(df: DataFrame) -> dict[str, Column]:
    flag = lambda c: (F.col(c) != S.NO_EVENT).cast("tinyint") if c in df.columns else F.lit(0).cast("tinyint")
    return {"has_event": flag("event_name_1"), "has_event_2": flag("event_name_2")}


def snap_flag(df: DataFrame) -> dict[str, Column]:
    """The flag of the row's own state; 0 elsewhere. Needs the state and all flags."""
    if not {"state_id", *S.SNAP_COLUMNS} <= set(df.columns):
        return {}
    out = F.lit(0)
    for s in S.STATES:
        out = F.when(F.col("state_id") == s, F.col(f"snap_{s}")).otherwise(out)
    return {"is_snap_day": out.cast("tinyint")}


def days_since_event() -> dict[str, Column]:
    """0 on an event's day, then rows since it; before a series' first event rows are counted from 1."""
    n = F.row_number().over(by_series())
    last = F.last(F.when(F.col("has_event") == 1, F.col("__n")), ignorenulls=True).over(by_series().rowsBetween(Window.unboundedPreceding, 0))
    return {"__n": n, "days_since_event": (F.col("__n") - F.coalesce(last, F.lit(0))).cast("smallint")}


def price_features(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Series means as a window on the one partitioning by series; the few, huge store and category groups as an
    aggregate joined back, since a window would put each in one task. ``base``: the staged frame that ``df`` adds
    columns to; without it ``df`` is staged, as it is read twice."""
    if base is None:
        base = df = Staging(df.sparkSession).table(df, "priced")[0]
    price = F.col("sell_price")
    lagged = F.coalesce(F.lag("sell_price", PRICE_LAG).over(by_series()), price)
    recent = F.avg("sell_price").over(last_rows(PRICE_ROWS)).cast("float")
    out = df.withColumns({"price_lag_7d": lagged.cast("float"), "price_rolling_mean_4w": F.coalesce(recent, price), "__series": F.avg("sell_price").over(Window.partitionBy("id")).cast("float")})
    groups = base.groupBy("store_id", "cat_id").agg(F.avg("sell_price").cast("float").alias("__group"))
    out = out.join(groups, ["store_id", "cat_id"], "left")
    return out.withColumns(
        {
            "price_change_7d": safe_divide(price - F.col("price_lag_7d"), "price_lag_7d", 0.0),
            "price_norm_by_item": safe_divide(price, "__series", 1.0),
            "price_norm_by_store_cat": safe_divide(price, "__group", 1.0),
            "is_price_promo": F.coalesce((price < F.col("price_rolling_mean_4w")).cast("tinyint"), F.lit(0).cast("tinyint")),
        }
    ).drop("__series", "__group")


def fit_codes(df: DataFrame, columns=S.ENCODED_COLUMNS) -> DataFrame:
    """(column, value, code): the place of each distinct string in binary order. Only distinct values are ranked."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, value string, code smallint")
    tuples = df.select(*[F.col(c).cast("string").alias(c) for c in present]).distinct()  # few, whatever the rows
    pairs = tuples.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in present])).alias("x"))
    distinct = pairs.select("x.*").where("value is not null").distinct()
    code = F.dense_rank().over(Window.partitionBy("column").orderBy("value")) - 1
    return distinct.withColumn("code", code.cast("smallint"))


def encode(df: DataFrame, codes: DataFrame, columns=S.ENCODED_COLUMNS, staging: Staging | None = None) -> DataFrame:
    """``{column}_enc`` by left joins; -1 for a value that was not there when the codes were fitted. Codes are staged, so
    they are made once, and Spark knows their size: it broadcasts them below its own limit and joins them otherwise."""
    present = [c for c in columns if c in df.columns]
    if present:
        codes, _ = (staging or Staging(df.sparkSession)).table(codes, "codes")
    for c in present:
        dim = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(f"{c}_enc"))
        df = df.join(dim, c, "left").withColumn(f"{c}_enc", F.coalesce(f"{c}_enc", F.lit(-1).cast("smallint")))
    return df


def null_safety(df: DataFrame) -> DataFrame:
    """What is still null after the features: by prefix, then by type. Dates are not filled."""
    out = {}
    for f in df.schema:
        c = f.name
        if isinstance(f.dataType, T.NumericType):
            if c.startswith(("sales_lag_", "rolling_")):
                value = F.lit(0)
            elif (c.startswith("price_") or c == "is_price_promo") and "sell_price" in df.columns:
                value = F.col("sell_price")
            else:
                value = F.lit(-1 if c.endswith("_enc") else 0)
            out[c] = F.coalesce(F.col(c), value.cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            out[c] = F.when(F.col(c).isNull(), F.lit(S.UNKNOWN)).otherwise(F.col(c))
    return df.withColumns(out)


def require_columns(df: DataFrame) -> None:
    if missing := sorted(set(S.REQUIRED["features"]) - set(df.columns)):
        raise ValueError(f"columns are missing: {missing}")


def feature_names(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in ("id", "d", "sales", "date")]


def build(df: DataFrame, config: S.FeatureConfig = S.FeatureConfig(), *, guard: bool = True) -> Features:
    """The feature matrix of a clean panel. All series windows share one shuffle by id and one sort. The input is staged
    once, as the codes, the group means and the windows read it; the guard counts its nulls as it passes."""
    staging, columns = Staging(df.sparkSession), df.columns
    if guard:
        require_columns(df)
        df = stage_without_nulls(df, staging, "panel", NullsGiven)
    else:
        df, _ = staging.table(df, "panel")
    out = df.withColumns(lag_features(config.lags))
    if config.windows:
        out = out.withColumns(rolling_features(config.windows, config.stats, f"sales_lag_{config.horizon}"))
    out = out.withColumns(calendar_features() | event_flags(df) | snap_flag(df))
    since = days_since_event()
    out = out.withColumn("__n", since["__n"]).withColumn("days_since_event", since["days_since_event"]).drop("__n")
    out = price_features(out, df)
    codes = fit_codes(df, config.encoded)
    out = null_safety(encode(out, codes, config.encoded, staging))
    made = [c for c in out.columns if c not in columns]
    out = out.select(*columns, *made)
    return Features(out, feature_names(out.columns), codes, staging)
