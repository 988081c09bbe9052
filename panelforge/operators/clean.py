"""Null-free cleaning of the merged panel by explicit, audited rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import schema as S
from panelforge.functions.scalars import by_series, day_index, fill_words, null_count, number, share_text
from panelforge.operators.quantiles import exact_quantiles
from panelforge.sources.staging import Staging


@dataclass
class Cleaned:
    """``df`` without nulls; ``audit``: (step, fixed, how), counted on the input; ``rows``: of the input.

    ``df`` reads tables in the shared folder, which stay until ``release``."""

    df: DataFrame
    audit: DataFrame
    rows: int
    staging: Staging

    def release(self) -> None:
        self.staging.release()

    def print_audit(self) -> None:
        """The steps that fixed anything, with their share of the rows."""
        for step in self.audit.where("fixed > 0").select("step", "fixed", share_text("fixed", F.lit(self.rows)).alias("share"), "how").collect():
            print(f"{step.step:<24} {step.fixed:>12,} {step.share:>8}  {step.how}")


def with_day_index(df: DataFrame) -> DataFrame:
    """d_int from d where it is absent or null, else 0."""
    parsed = [day_index("d")] if "d" in df.columns else []
    held = [number("d_int", "smallint")] if "d_int" in df.columns else []
    return df.withColumn("d_int", F.coalesce(*held, *parsed, F.lit(0).cast("smallint")))


def clean_sales(c: str = "sales") -> Column:
    return F.greatest(F.coalesce(number(c), F.lit(0).cast("float")), F.lit(0).cast("float"))


def clean_integers() -> dict[str, Column]:
    defaults = {"wday": (S.WDAY, "tinyint"), "month": (S.MONTH, "tinyint"), "year": (S.YEAR, "smallint")}
    return {c: F.coalesce(number(c, kind), F.lit(v).cast(kind)) for c, (v, kind) in defaults.items()}


def clean_snap() -> dict[str, Column]:
    return {c: F.coalesce(number(c, "tinyint"), F.lit(0).cast("tinyint")) for c in S.SNAP_COLUMNS}


def filled_price() -> Column:
    """Forward, then backward, within a series."""
    return F.coalesce(*_last_and_first(number("sell_price")))


def _last_and_first(value: Column) -> tuple[Column, Column]:
    """The last known value up to a row, and the series' first known one. That is the next known one for rows before it,
    which are all that lack the former; taken once a series, as a frame of following rows would be read anew for each row."""
    return (
        F.last(value, ignorenulls=True).over(by_series().rowsBetween(Window.unboundedPreceding, 0)),
        F.first(value, ignorenulls=True).over(by_series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )


def fill_prices(df: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Series fill, then the median of what is filled (PRICE_FALLBACK if there is none or it isn't positive), then the
    cap at a high quantile and the floor. The cap is taken after the fallback. Both figures are ranks found by counting,
    over the filled prices alone, which are staged as a table of one column; each meets the rows as one broadcast row."""
    staging = staging or Staging(df.sparkSession)
    step = df.withColumn("sell_price", filled_price())
    prices, _ = staging.table(step.select("sell_price"), "prices")
    m = F.col("q0")
    median = exact_quantiles(prices, "sell_price", [0.5]).select(F.when(m > 0, m).otherwise(S.PRICE_FALLBACK).cast("float").alias("__median"))
    median, _ = staging.table(median, "median")
    known = lambda frame: frame.crossJoin(F.broadcast(median)).withColumn("sell_price", F.coalesce("sell_price", "__median")).drop("__median")
    cap, _ = staging.table(exact_quantiles(known(prices), "sell_price", [S.PRICE_CAP]).select(F.col("q0").cast("float").alias("__cap")), "cap")
    capped = F.least("sell_price", "__cap")
    floored = F.when(capped <= 0, F.lit(S.PRICE_FLOOR).cast("float")).otherwise(capped)
    return known(step).crossJoin(F.broadcast(cap)).withColumn("sell_price", floored.cast("float")).drop("__cap")


def fill_weeks(df: DataFrame, staging: Staging | None = None) -> DataFrame:
    """wm_yr_wk forward, then backward, over the whole table in (id, d_int) order, across series.

    Without a window over everything: one aggregate gives each series' first and last week, one row each. These are
    filled within ranges of series, and between ranges by one row a range, and come back by a join on id. A gap takes
    the last week before it in its series, else of the series before, else the first after it in its series, else of
    the series after."""
    week = number("wm_yr_wk", "smallint")
    weeks = df.withColumn("__w", week)
    known = F.when(F.col("__w").isNotNull(), F.struct("d_int", "__w"))
    each = weeks.groupBy("id").agg(F.min(known)["__w"].alias("first"), F.max(known)["__w"].alias("last"))
    # staged, as a range must hold the same series wherever it is read
    each, _ = (staging or Staging(df.sparkSession)).table(each.repartitionByRange("id").withColumn("range", F.spark_partition_id()), "weeks")
    ends = each.groupBy("range").agg(F.max(F.when(F.col("last").isNotNull(), F.struct("id", "last")))["last"].alias("l"), F.min(F.when(F.col("first").isNotNull(), F.struct("id", "first")))["first"].alias("f"))

    def around(parts: list, at: str, last: str, first: str):
        """The last known value before a row, the first known one after it."""
        known = lambda c, order: F.last(c, ignorenulls=True).over(Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
        return known(last, F.asc(at)), known(first, F.desc(at))

    before, after = around([F.lit(0)], "range", "l", "f")  # a row for each shuffle partition
    ends = ends.select("range", before.alias("b"), after.alias("a"))
    before, after = around(["range"], "id", "last", "first")
    inside = each.select("id", "range", before.alias("__before"), after.alias("__after")).join(F.broadcast(ends), "range")
    inside = inside.select("id", F.coalesce("__before", "b").alias("__before"), F.coalesce("__after", "a").alias("__after"))
    filled = weeks.withColumns(dict(zip(("__f", "__b"), _last_and_first(F.col("__w")))))
    value = F.coalesce("__f", "__before", "__b", "__after", F.lit(S.WEEK).cast("smallint"))
    return filled.join(inside, "id").withColumn("wm_yr_wk", value).drop("__w", "__f", "__b", "__before", "__after")


def catch_all(df: DataFrame, had_null: set[str], done: set[str] = frozenset()) -> DataFrame:
    """Remaining nulls: numbers 0, text UNKNOWN. Words that stand for null go too, but only in text columns that had a
    null. Dates are not filled."""
    out = {}
    for f in df.schema:
        if f.name in done:
            continue
        if isinstance(f.dataType, T.NumericType):
            out[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType) and f.name in had_null:
            out[f.name] = fill_words(f.name, S.UNKNOWN)
    return df.withColumns(out) if out else df


def _audit_counts(df: DataFrame) -> dict[str, Column]:
    """Counts of what each rule will fix, and nulls per column."""
    rules = {}
    if "sales" in df.columns:
        value = number("sales")
        rules["sales_fix"] = F.count_if(value.isNull() | (value < 0))
    for c in [*S.EVENT_COLUMNS, "weekday"]:
        if c in df.columns:
            rules[f"fill_{c}"] = null_count(c)
    for c in ["sell_price", *S.SNAP_COLUMNS, "wday", "month", "year", "wm_yr_wk"]:
        if c in df.columns:
            rules[f"fill_{c}"] = F.count_if(number(c).isNull())
    if "d_int" in df.columns:
        rules["fill_d_int"] = null_count("d_int")
    return rules | {f"nulls_{c}": null_count(c) for c in df.columns}


_HOW = {
    "sales_fix": "null and negative to 0",
    "fill_sell_price": "forward and backward within the series, median, cap, floor",
    "fill_wm_yr_wk": "forward and backward over all series",
    "fill_d_int": "parsed from d, else 0",
}


def audit(df: DataFrame) -> DataFrame:
    """(step, fixed, how): one aggregate over ``df`` before it is cleaned."""
    steps = {c: v for c, v in _audit_counts(df).items() if not c.startswith("nulls_")}
    counts = df.agg(*[v.alias(c) for c, v in steps.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).cast("long").alias("fixed"), F.lit(_HOW.get(c, "constant")).alias("how")) for c in steps])
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def clean(df: DataFrame, *, guard: bool = True) -> Cleaned:
    """All rules in order, then the guard that no null is left (``date`` is filled by none and so makes it raise).

    The input is staged once, and the audit is counted as it passes: what each rule fixes, whether any price is null
    (only then prices are filled, capped and floored) and which text columns had nulls. The guard counts nulls as the
    output is staged, so that guarded rows are computed once. The order within a series is always the numeric day.
    """
    staging = Staging(df.sparkSession)
    df, counts = staging.table(df, "raw", {"rows": F.count(F.lit(1)), **_audit_counts(df)})
    n = counts.pop("rows")
    steps = [(k, int(v), _HOW.get(k, "constant")) for k, v in counts.items() if not k.startswith("nulls_")]
    report = df.sparkSession.createDataFrame(steps, "step string, fixed bigint, how string")
    had_null = {k.removeprefix("nulls_") for k, v in counts.items() if k.startswith("nulls_") and v}
    out = with_day_index(df)
    rules: dict[str, Column] = {}
    if "sales" in df.columns:
        rules["sales"] = clean_sales()
    rules |= {c: fill_words(c, S.NO_EVENT) for c in S.EVENT_COLUMNS if c in df.columns}
    rules |= {c: v for c, v in (clean_snap() | clean_integers()).items() if c in df.columns}
    if "weekday" in df.columns:
        rules["weekday"] = fill_words("weekday", S.WEEKDAY)
    out = out.withColumns(rules)
    if "sell_price" in df.columns:
        if counts["fill_sell_price"]:
            out = fill_prices(out, staging)
        else:
            out = out.withColumn("sell_price", number("sell_price"))
    if "wm_yr_wk" in df.columns:
        out = fill_weeks(out, staging) if counts["fill_wm_yr_wk"] else out.withColumn("wm_yr_wk", number("wm_yr_wk", "smallint"))
    out = catch_all(out, had_null, done=set(rules) | {"d_int", "sell_price", "wm_yr_wk"}).select(*dict.fromkeys([*df.columns, "d_int"]))
    if guard:
        out = stage_without_nulls(out, staging, "clean")
    return Cleaned(out, report, n, staging)


def null_ranking(df: DataFrame) -> DataFrame:
    """(place, column, nulls) of the columns with nulls, most first, then by name."""
    counts = df.agg(*[v.alias(c) for c, v in null_figures(df).items()])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("long").alias("nulls")) for c in df.columns])
    found = F.filter(rows, lambda r: r["nulls"] > 0)
    first = F.array_sort(F.transform(found, lambda r: F.struct((-r["nulls"]).alias("less"), r["column"].alias("column"))))
    return counts.select(F.posexplode(first).alias("at", "x")).select((F.col("at") + 1).alias("place"), "x.column", (-F.col("x.less")).alias("nulls"))


class NullsLeft(RuntimeError):
    """``counts``: columns with nulls, most first."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"nulls are left: {counts}")
        self.counts = counts


class NullsGiven(NullsLeft, ValueError):
    """Nulls in a frame that must come without."""


def stage_without_nulls(df: DataFrame, staging: Staging, name: str, error: type[NullsLeft] = NullsLeft) -> DataFrame:
    """``df`` staged, its nulls counted as they pass. Any null is refused, and what was staged goes."""
    out, found = staging.table(df, name, null_figures(df))
    try:
        refuse_nulls(found, error)
    except NullsLeft:
        staging.release()
        raise
    return out


def null_figures(df: DataFrame) -> dict[str, Column]:
    return {c: null_count(c) for c in df.columns}


def refuse_nulls(counts: dict[str, int], error: type[NullsLeft] = NullsLeft) -> None:
    if left := dict(sorted(((c, n) for c, n in counts.items() if n), key=lambda x: (-x[1], x[0]))):
        raise error(left)
