"""Column expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import schema as S

Columnish = Column | str


def col(c: Columnish) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_index(d: Columnish) -> Column:
    """``d_17`` -> 17; null where that is no small integer."""
    return F.replace(col(d), F.lit("d_"), F.lit("")).try_cast("smallint")


def number(c: Columnish, kind: str = "float") -> Column:
    """Coercing cast: null for what is no number, and for NaN."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value).try_cast(kind)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float and double columns with NaN as null, the one kind of missing value in the panel."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def is_missing(c: Columnish) -> Column:
    """Null, or one of the words that stand for it (case counts)."""
    return col(c).isNull() | col(c).isin(S.NAN_WORDS)


def fill_words(c: Columnish, value: str) -> Column:
    return F.when(is_missing(c), F.lit(value)).otherwise(col(c))


def safe_divide(num: Columnish, den: Columnish, fill: float) -> Column:
    """Quotient in double, ``fill`` where it has no finite value; kept as float."""
    q = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    finite = ~F.isnan(q) & (F.abs(q) < float("inf"))
    return F.coalesce(F.when(finite, q), F.lit(fill)).cast("float")


def by_series() -> WindowSpec:
    """Rows of a series in day order; (id, d_int) is unique, so the order is total."""
    return Window.partitionBy("id").orderBy("d_int")


def last_rows(n: int) -> WindowSpec:
    return by_series().rowsBetween(-(n - 1), 0)


def date(c: Columnish) -> Column:
    """Coercing parse: null for what is no date."""
    return col(c).try_cast("date")


def share_text(part: Columnish, whole: Columnish) -> Column:
    """``part`` as a percentage of ``whole``, with two decimals and a sign; of nothing it is 0."""
    share = F.coalesce(F.try_divide(col(part) * 100.0, col(whole)), F.lit(0.0))
    return F.format_string("%.2f%%", share)


def null_count(c: str) -> Column:
    return F.count_if(F.col(f"`{c}`").isNull())
