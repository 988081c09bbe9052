"""Wide to long and back, lean projections, type narrowing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import schema as S
from panelforge.functions.scalars import day_index


def lean(df: DataFrame, keep: Sequence[str] = S.CALENDAR_COLUMNS) -> DataFrame:
    return df.select(*[c for c in keep if c in df.columns])


def melt_days(wide: DataFrame, days: Sequence[str] | None = None, ids: Sequence[str] = S.ID_COLUMNS) -> DataFrame:
    """One row per series and day column, null cells included: one float array exploded with its positions, which give
    the names, so one narrow pass."""
    days = list(days) if days is not None else [c for c in wide.columns if c.startswith("d_") and c[2:].isdigit()]
    if not days:
        return wide.select(*ids, F.lit(None).cast("string").alias("d"), F.lit(None).cast("float").alias("sales"), F.lit(None).cast("smallint").alias("d_int")).where("false")
    cells = wide.select(*ids, F.posexplode(F.array(*[F.col(c).cast("float") for c in days])).alias("__at", "sales"))
    name = F.element_at(F.array(*[F.lit(c) for c in days]), F.col("__at") + 1)
    return cells.select(*ids, name.alias("d"), "sales").withColumn("d_int", day_index("d"))


def widen_days(long: DataFrame, days: Sequence[str], ids: Sequence[str] = S.ID_COLUMNS) -> DataFrame:
    """The inverse of ``melt_days`` for the stated days."""
    return long.groupBy(*ids).pivot("d", list(days)).agg(F.first("sales"))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def pivot(df: DataFrame, index: str, column: str, value: str, values: Sequence[str]) -> DataFrame:
    """A column per stated value; (index, column) must be unique, as nothing is aggregated."""
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("pivot: repeated (index, column)")).cast(df.schema[value].dataType)).otherwise(F.first(value))
    return df.groupBy(index).pivot(column, list(values)).agg(one)


# The narrowest integer that holds a range, in order.
_INTEGERS = (("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -(2**31), 2**31 - 1))


def cast_plan(df: DataFrame, ratio: float = 0.5) -> DataFrame:
    """(column, type, categorical) from one pass over ``df``: doubles become float, int and long the narrowest integer
    that holds their range, and a string column counts as categorical if its distinct values are under ``ratio`` of the
    rows. An empty frame keeps its types."""
    ints = [f.name for f in df.schema if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{k}_{c}") for c in ints for k, f in (("min", F.min), ("max", F.max))],
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in strings],
    )
    rows = []
    for c in ints:
        kind = F.lit("bigint")
        for name, low, high in reversed(_INTEGERS):
            kind = F.when((F.col(f"min_{c}") >= low) & (F.col(f"max_{c}") <= high), F.lit(name)).otherwise(kind)
        rows.append(F.struct(F.lit(c).alias("column"), kind.alias("type"), F.lit(False).alias("categorical")))
    rows += [F.struct(F.lit(c).alias("column"), F.lit("float").alias("type"), F.lit(False).alias("categorical")) for c in doubles]
    rows += [
        F.struct(F.lit(c).alias("column"), F.lit("string").alias("type"), F.coalesce(F.try_divide(F.col(f"distinct_{c}"), F.col("rows")) < ratio, F.lit(False)).alias("categorical"))
        for c in strings
    ]
    return stats.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def narrow_types(df: DataFrame) -> DataFrame:
    """A new frame with the casts of ``cast_plan`` (bounded by the number of columns)."""
    kinds = {r["column"]: r["type"] for r in cast_plan(df).collect() if r["type"] != "bigint"}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])
