"""Checks of the raw tables and of the panel."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import schema as S
from panelforge.functions.scalars import null_count
from panelforge.operators.enrich import uncovered_prices


@dataclass(frozen=True)
class CheckResult:
    name: str
    passed: bool
    message: str
    details: dict = field(default_factory=dict)


@dataclass(frozen=True)
class ValidationReport:
    checks: list[CheckResult]

    @property
    def n_passed(self) -> int:
        return sum(c.passed for c in self.checks)

    @property
    def n_failed(self) -> int:
        return len(self.checks) - self.n_passed

    @property
    def passed(self) -> bool:
        return self.n_failed == 0

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c.name, c.passed, c.message) for c in self.checks], "name string, passed boolean, message string")

    def print_report(self) -> None:
        """Lists the checks; raises if any failed."""
        for c in self.checks:
            print(f"{'pass' if c.passed else 'FAIL'}  {c.name:<40} {c.message}")
        if not self.passed:
            raise RuntimeError(f"{self.n_failed} of {len(self.checks)} checks failed")


@dataclass(frozen=True)
class Expected:
    """Sizes of the full data; smaller inputs state their own."""

    series: int = S.SERIES
    days: int = S.LAST_DAY
    calendar_rows: int = S.CALENDAR_ROWS
    states: tuple[str, ...] = tuple(S.STATES)


def _columns(name: str, df: DataFrame) -> CheckResult:
    missing = sorted(set(S.REQUIRED[name]) - set(df.columns))
    return CheckResult(f"schema:{name}", not missing, f"missing: {missing}" if missing else "all there", {"missing": missing})


def _nulls(name: str, counts: dict, warn_only: set[str]) -> CheckResult:
    bad = {c: n for c, n in counts.items() if n and c not in warn_only}
    return CheckResult(f"nulls:{name}", not bad, f"nulls in {bad}" if bad else "none unexpected", bad)


def _figures(df: DataFrame, **more) -> tuple[dict, dict]:
    """Nulls per column and other one-row figures, in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[null_count(c).alias(f"n_{c}") for c in df.columns], *[v.alias(k) for k, v in more.items()]).first().asDict()
    return {c: row[f"n_{c}"] for c in df.columns}, row


def _negative(name: str, what: str, n: int | None) -> CheckResult:
    return CheckResult(f"business_rule:{name}", not n, f"{n or 0} negative {what}")


def validate_raw(calendar: DataFrame, prices: DataFrame, sales_meta: DataFrame, *, expected: Expected = Expected(), strict: bool = False, coverage: bool = False) -> ValidationReport:
    """Eleven checks, one pass over each table. ``strict`` fails on nulls in event columns too; they are mostly null by
    nature, so by default they only warn. ``coverage`` adds day continuity and repeated price keys."""
    first, last = F.bool_or(F.col("d") == "d_1"), F.bool_or(F.col("d") == f"d_{expected.days}")
    cal_nulls, cal = _figures(calendar, first=first, last=last)
    price_nulls, price = _figures(prices, negative=F.count_if(F.col("sell_price") < 0))
    meta_nulls, meta = _figures(sales_meta, **{f"state_{s}": F.bool_or(F.col("state_id") == s) for s in expected.states})
    absent = [s for s in expected.states if not meta[f"state_{s}"]]
    checks = [
        _columns("calendar", calendar),
        _columns("prices", prices),
        _columns("sales_meta", sales_meta),
        _nulls("calendar", cal_nulls, set() if strict else set(S.EVENT_COLUMNS)),
        _nulls("prices", price_nulls, set()),
        _nulls("sales_meta", meta_nulls, set()),
        CheckResult("row_count:calendar", cal["__rows"] >= expected.calendar_rows, f"{cal['__rows']} rows, at least {expected.calendar_rows} expected"),
        CheckResult("row_count:sales_meta", meta["__rows"] == expected.series, f"{meta['__rows']} series, {expected.series} expected"),
        _negative("price_non_negative", "prices", price["negative"]),
        CheckResult("date_range:calendar", bool(cal["first"] and cal["last"]), f"d_1: {bool(cal['first'])}, d_{expected.days}: {bool(cal['last'])}"),
        CheckResult("business_rule:states", not absent, f"missing: {absent}" if absent else "all there", {"missing": absent}),
    ]
    if coverage:
        n = calendar.select("d").distinct().count()
        keys = prices.groupBy("store_id", "item_id", "wm_yr_wk").count().where("count > 1").count()
        checks += [
            CheckResult("continuity:calendar", n == cal["__rows"], f"{n} days in {cal['__rows']} rows"),
            CheckResult("unique:prices", keys == 0, f"{keys} repeated keys"),
        ]
    return ValidationReport(checks)


def validate_processed(df: DataFrame, *, expected: Expected = Expected(), prices: DataFrame | None = None) -> ValidationReport:
    """Five checks in one pass; prices without a match only warn. With ``prices`` their coverage is checked too."""
    nulls, row = _figures(df, negative=F.count_if(F.col("sales") < 0))
    want = expected.series * expected.days
    checks = [
        _columns("processed_long", df),
        _negative("sales_non_negative", "sales", row["negative"]),
        _nulls("processed_long", nulls, {"sell_price"}),
        CheckResult("row_count:processed_long", row["__rows"] == want, f"{row['__rows']} rows, {want} expected"),
        CheckResult("leakage_guard:d_int_present", "d_int" in df.columns, "d_int is there" if "d_int" in df.columns else "no d_int: splits can't be made by time"),
    ]
    if prices is not None:
        n = uncovered_prices(df, prices).count()
        checks.append(CheckResult("coverage:prices", n == 0, f"{n} keys without a price"))
    return ValidationReport(checks)
