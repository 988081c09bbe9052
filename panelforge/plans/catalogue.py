"""A query for each operator over the driver's tables, beside its SQL."""

from __future__ import annotations

import contextlib
import functools
import io
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import schema as S
from panelforge.functions.scalars import date, day_index, null_count, number, safe_divide, share_text
from panelforge.operators import clean as C
from panelforge.operators import enrich, explore, inventory, reshape, validate
from panelforge.operators import features as X
from panelforge.plans import panel, store
from panelforge.sources import adapter, readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.merged(adapter.sales_long(spark, sf_dir), adapter.calendar(spark, sf_dir), adapter.prices(spark, sf_dir))


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with its calendar, for what needs no price."""
    return enrich.join_calendar(adapter.sales_long(spark, sf_dir), adapter.calendar(spark, sf_dir))


# Both engines read these: faults put into the panel at fixed places, so that every cleaning rule has work.
_K = "(d_int + length(id))"
FAULTS = {
    "sales": f"CASE WHEN {_K} % 101 = 0 THEN NULL WHEN {_K} % 103 = 0 THEN CAST(-3 AS FLOAT) ELSE sales END",
    "event_name_1": f"CASE WHEN {_K} % 89 = 0 THEN 'nan' ELSE event_name_1 END",
    "event_type_2": f"CASE WHEN {_K} % 97 = 0 THEN 'None' ELSE event_type_2 END",
    "weekday": f"CASE WHEN {_K} % 107 = 0 THEN NULL WHEN {_K} % 109 = 0 THEN '' ELSE weekday END",
    "snap_TX": f"CASE WHEN {_K} % 113 = 0 THEN NULL ELSE snap_TX END",
    "wday": f"CASE WHEN {_K} % 127 = 0 THEN NULL ELSE wday END",
    "month": f"CASE WHEN {_K} % 131 = 0 THEN NULL ELSE month END",
    "year": f"CASE WHEN {_K} % 137 = 0 THEN NULL ELSE year END",
    "wm_yr_wk": "CASE WHEN d_int % 50 < 9 OR length(id) % 7 = 0 THEN NULL ELSE wm_yr_wk END",
    "cat_id": f"CASE WHEN {_K} % 139 = 0 THEN NULL WHEN {_K} % 149 = 0 THEN 'NaN' ELSE cat_id END",
}


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = merged(spark, sf_dir)
    return df.select(*[F.expr(FAULTS[c]).alias(c) if c in FAULTS else F.col(c) for c in df.columns])


def tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel without faults, with event words and filled prices: what features are made of."""
    df = merged(spark, sf_dir)
    df = df.withColumn("sell_price", F.coalesce(C.filled_price(), F.lit(1.0).cast("float")))
    return df.withColumns({c: F.coalesce(c, F.lit(S.NO_EVENT)) for c in S.EVENT_COLUMNS})


def _case_events(table, at: int) -> str:
    rows = " ".join(f"WHEN strftime(date, '%m-%d') = '{e[0]}' THEN '{e[at]}'" for e in table)
    return f"CASE {rows} END"


_IDS = "item_id || '_' || store_id AS id, item_id, item_id AS dept_id, CASE WHEN item_id IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'SIZED' ELSE 'TIERED' END AS cat_id, store_id, state_id"
_REGIONS = " ".join(f"WHEN r_name = '{r}' THEN '{s}'" for s, (r, _) in adapter.REGION_OF.items())
_SNAPS = ", ".join(f"CAST(day(date) BETWEEN {f} AND {f + 9} AS TINYINT) AS snap_{s}" for s, (_, f) in adapter.REGION_OF.items())
BASE = f"""WITH sold AS (
  SELECT p_type AS item_id, n_name AS store_id, CASE {_REGIONS} ELSE r_name END AS state_id, CAST(l_shipdate AS DATE) AS date,
         l_quantity, l_extendedprice / l_quantity AS unit
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), meta AS (
  SELECT DISTINCT {_IDS} FROM sold
), days AS (
  SELECT CAST(date_diff('day', first, day) + 1 AS SMALLINT) AS d_int, CAST(day AS DATE) AS date
  FROM (SELECT first, unnest(generate_series(first, last, INTERVAL 1 DAY)) AS day FROM (SELECT CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem) WHERE first IS NOT NULL)
), cal AS (
  SELECT date, CAST(11101 + floor((d_int - 1) / 7) AS SMALLINT) AS wm_yr_wk, dayname(date) AS weekday,
         CAST((dayofweek(date) + 1) % 7 + 1 AS TINYINT) AS wday, CAST(month(date) AS TINYINT) AS month, CAST(year(date) AS SMALLINT) AS year,
         'd_' || d_int AS d, {_case_events(adapter.EVENTS_1, 1)} AS event_name_1, {_case_events(adapter.EVENTS_1, 2)} AS event_type_1,
         {_case_events(adapter.EVENTS_2, 1)} AS event_name_2, {_case_events(adapter.EVENTS_2, 2)} AS event_type_2, {_SNAPS}, d_int
  FROM days
), prices AS (
  SELECT store_id, item_id, CAST(11101 + floor(date_diff('day', DATE '{adapter.FIRST_DATE}', date) / 7) AS SMALLINT) AS wm_yr_wk, CAST(max(unit) AS FLOAT) AS sell_price
  FROM sold GROUP BY ALL
), daily AS (
  SELECT item_id, store_id, date, sum(l_quantity) AS q FROM sold GROUP BY ALL
), long AS (
  SELECT meta.*, cal.d, cal.d_int, CAST(coalesce(q, 0) AS FLOAT) AS sales
  FROM meta CROSS JOIN cal LEFT JOIN daily USING (item_id, store_id, date)
), merged AS (
  SELECT long.*, cal.* EXCLUDE (d, d_int), sell_price
  FROM long JOIN cal USING (d_int) LEFT JOIN prices USING (store_id, item_id, wm_yr_wk)
)"""
_UP = "PARTITION BY id ORDER BY d_int ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_DOWN = "PARTITION BY id ORDER BY d_int ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
_FILL = f"coalesce(last_value(sell_price IGNORE NULLS) OVER ({_UP}), first_value(sell_price IGNORE NULLS) OVER ({_DOWN}))"
_EVENTS_FILLED = ", ".join(f"coalesce({c}, '{S.NO_EVENT}') AS {c}" for c in S.EVENT_COLUMNS)
TIDY = f"""{BASE}, tidy AS (
  SELECT * REPLACE ({_EVENTS_FILLED}, coalesce({_FILL}, CAST(1.0 AS FLOAT)) AS sell_price) FROM merged
)"""
FAULTY = f"{BASE}, faulty AS (SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in FAULTS.items())}) FROM merged)"
_WORDS = "('nan', 'NaN', 'None', '<NA>', '')"


def _word(c: str, value: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN {_WORDS} THEN '{value}' ELSE {c} END AS {c}"


_CLEANED = ", ".join(
    [
        "CASE WHEN sales IS NULL OR sales < 0 THEN CAST(0 AS FLOAT) ELSE sales END AS sales",
        *[_word(c, S.NO_EVENT) for c in S.EVENT_COLUMNS],
        _word("weekday", S.WEEKDAY),
        _word("cat_id", S.UNKNOWN),
        *[f"coalesce({c}, 0) AS {c}" for c in S.SNAP_COLUMNS],
        "coalesce(wday, 1) AS wday, coalesce(month, 1) AS month, coalesce(year, 2011) AS year",
        "CAST(CASE WHEN least(coalesce(fp, m), cap) <= 0 THEN 0.01 ELSE least(coalesce(fp, m), cap) END AS FLOAT) AS sell_price",
        "w AS wm_yr_wk",
    ]
)
_WEEK = """coalesce(last_value(wm_yr_wk IGNORE NULLS) OVER (ORDER BY id, d_int ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(wm_yr_wk IGNORE NULLS) OVER (ORDER BY id, d_int ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 11101)"""
CLEAN = f"""{FAULTY}, filled AS (
  SELECT *, {_FILL} AS fp, {_WEEK} AS w FROM faulty
), med AS (
  SELECT CAST(CASE WHEN median(CAST(fp AS DOUBLE)) > 0 THEN median(CAST(fp AS DOUBLE)) ELSE 1.0 END AS FLOAT) AS m FROM filled
), top AS (
  SELECT CAST(quantile_cont(CAST(coalesce(fp, m) AS DOUBLE), 0.9999) AS FLOAT) AS cap FROM filled, med
), clean AS (
  SELECT * EXCLUDE (fp, w, m, cap) REPLACE ({_CLEANED}) FROM filled, med, top
)"""


def register(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE_SQL[name] = sql


# Scans, projections, reshapes
_ALL_DAYS = [f"d_{n}" for n in range(1, adapter.DAYS + 1)]
register("scan_prune", lambda s, d: adapter.sales_meta(s, d).select(*S.ID_COLUMNS), f"{BASE} SELECT id, item_id, dept_id, cat_id, store_id, state_id FROM meta")
register("day_range_scan", lambda s, d: adapter.sales_long(s, d).where(F.col("d_int").between(100, 127)).select("id", "d", "sales"), f"{BASE} SELECT id, d, sales FROM long WHERE d_int BETWEEN 100 AND 127")
register("lean_projection", lambda s, d: reshape.lean(adapter.calendar(s, d)), f"{BASE} SELECT * FROM cal")
register("price_scan", lambda s, d: adapter.prices(s, d), f"{BASE} SELECT * FROM prices")
for _name in ("melt_days", "melt_all_days"):  # the second name is that of an earlier round
    register(
        _name,
        lambda s, d: reshape.melt_days(reshape.widen_days(adapter.sales_long(s, d), _ALL_DAYS)),
        f"{BASE} SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, sales, d_int FROM long",
    )
register("pivot_zero_rate", lambda s, d: explore.zero_rate_matrix(adapter.sales_long(s, d), ["SIZED", "TIERED"]), f"""{BASE}, r AS (SELECT store_id, cat_id, avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) AS z FROM long GROUP BY ALL)
SELECT store_id, max(z) FILTER (cat_id = 'SIZED') AS "SIZED", max(z) FILTER (cat_id = 'TIERED') AS "TIERED" FROM r GROUP BY store_id""")
register("parse_day_index", lambda s, d: adapter.calendar(s, d).select("d", day_index("d").alias("parsed")), f"{BASE} SELECT d, CAST(replace(d, 'd_', '') AS SMALLINT) AS parsed FROM cal")
register("cast_plan_min_max", lambda s, d: reshape.cast_plan(adapter.table(s, d, "part")), """
SELECT 'p_size' AS "column", CASE WHEN min(p_size) >= -128 AND max(p_size) <= 127 THEN 'tinyint' WHEN min(p_size) >= -32768 AND max(p_size) <= 32767 THEN 'smallint' ELSE 'int' END AS type, false AS categorical FROM part
UNION ALL SELECT 'p_partkey', CASE WHEN min(p_partkey) >= -128 AND max(p_partkey) <= 127 THEN 'tinyint' WHEN min(p_partkey) >= -32768 AND max(p_partkey) <= 32767 THEN 'smallint' WHEN max(p_partkey) <= 2147483647 THEN 'int' ELSE 'bigint' END, false FROM part
UNION ALL SELECT 'p_retailprice', 'float', false
UNION ALL SELECT 'p_name', 'string', count(DISTINCT p_name) / count(*) < 0.5 FROM part
UNION ALL SELECT 'p_brand', 'string', count(DISTINCT p_brand) / count(*) < 0.5 FROM part
UNION ALL SELECT 'p_type', 'string', count(DISTINCT p_type) / count(*) < 0.5 FROM part""")



def _all_chunks(s: SparkSession, d: str, size: int = 500) -> DataFrame:
    """The wide table of all days melted in ranges of ``size`` days, joined as a bag."""
    wide = reshape.widen_days(adapter.sales_long(s, d), _ALL_DAYS)
    parts = [reshape.melt_days(wide, _ALL_DAYS[a : a + size]).select("id", "d", "sales", "d_int") for a in range(0, len(_ALL_DAYS), size)]
    return functools.reduce(DataFrame.unionByName, parts)


# Joins
register("join_calendar_left", lambda s, d: enrich.join_calendar(adapter.sales_long(s, d), adapter.calendar(s, d)).select("id", "d_int", "date", "wm_yr_wk", "event_name_1", "snap_CA"), f"{BASE} SELECT id, d_int, date, wm_yr_wk, event_name_1, snap_CA FROM merged")
register("join_prices_left", lambda s, d: merged(s, d).select("id", "d_int", "sales", "sell_price"), f"{BASE} SELECT id, d_int, sales, sell_price FROM merged")
register("price_coverage_anti", lambda s, d: enrich.uncovered_prices(merged(s, d), adapter.prices(s, d)), f"{BASE} SELECT DISTINCT store_id, item_id, wm_yr_wk FROM merged WHERE NOT EXISTS (SELECT 1 FROM prices p WHERE p.store_id = merged.store_id AND p.item_id = merged.item_id AND p.wm_yr_wk = merged.wm_yr_wk)")

# Aggregates
_AUDITED = ["sales", "event_name_1", "weekday", "wm_yr_wk", "sell_price", "cat_id"]
register("null_audit", lambda s, d: faulty(s, d).agg(*[null_count(c).alias(c) for c in _AUDITED]), f"{FAULTY} SELECT {', '.join(f'count(*) FILTER ({c} IS NULL) AS {c}' for c in _AUDITED)} FROM faulty")
register("negative_count", lambda s, d: faulty(s, d).agg(F.count_if(F.col("sales") < 0).alias("negative")), f"{FAULTY} SELECT count(*) FILTER (sales < 0) AS negative FROM faulty")
register("split_counts", lambda s, d: adapter.sales_long(s, d).groupBy(store.split_of().alias("split")).count().withColumnRenamed("count", "n"), f"{BASE} SELECT CASE WHEN d_int <= 1800 THEN 'train' WHEN d_int <= 1856 THEN 'valid' WHEN d_int <= 1913 THEN 'test' END AS split, count(*) AS n FROM long GROUP BY ALL")
register("national_daily", lambda s, d: explore.national_daily(dated(s, d)), f"{BASE} SELECT date, sum(CAST(sales AS DOUBLE)) AS sales FROM merged GROUP BY date")
register("state_daily", lambda s, d: explore.state_daily(dated(s, d)), f"{BASE} SELECT date, state_id, sum(CAST(sales AS DOUBLE)) AS sales FROM merged GROUP BY ALL")
for _key in ("wday", "month"):
    register(f"mean_by_{_key}", lambda s, d, k=_key: explore.mean_by(dated(s, d), k), f"{BASE} SELECT {_key}, avg(CAST(sales AS DOUBLE)) AS mean_sales FROM merged GROUP BY ALL")
register("zero_rate_store_cat", lambda s, d: explore.zero_rate(adapter.sales_long(s, d)), f"{BASE} SELECT store_id, cat_id, avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) AS zero_rate FROM long GROUP BY ALL")
register("median_by_cat", lambda s, d: explore.median_by_category(adapter.sales_long(s, d)), f"{BASE} SELECT cat_id, median(CAST(sales AS DOUBLE)) AS median_sales FROM long WHERE sales > 0 GROUP BY cat_id")
register("snap_effect", lambda s, d: explore.snap_effect(dated(s, d)), " UNION ALL ".join(
    f"SELECT * FROM ({BASE} SELECT state_id, avg(CAST(sales AS DOUBLE)) FILTER (snap_{x} = 1) AS snap_mean, avg(CAST(sales AS DOUBLE)) FILTER (snap_{x} = 0) AS other_mean FROM merged WHERE state_id = '{x}' GROUP BY state_id)" for x in S.STATES))
register("summary_stats", lambda s, d: explore.summary(merged(s, d), adapter.calendar(s, d), adapter.prices(s, d)), f"""{BASE}
SELECT count(*) AS rows, count(DISTINCT id) AS series, count(DISTINCT store_id) AS stores, count(DISTINCT state_id) AS states, min(date) AS first_date, max(date) AS last_date,
       avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) * 100 AS zero_pct, avg(CAST(sales AS DOUBLE)) AS mean_sales,
       (SELECT count(*) FROM cal) AS calendar_rows, (SELECT count(*) FROM prices) AS price_rows,
       (SELECT median(CAST(sell_price AS DOUBLE)) FROM prices) AS median_price, (SELECT CAST(max(sell_price) AS DOUBLE) FROM prices) AS max_price
FROM merged""")
register("sales_histogram", lambda s, d: explore.histogram(adapter.sales_long(s, d)), f"""{BASE}, v AS (SELECT CAST(sales AS DOUBLE) AS x FROM long WHERE sales > 0), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
c AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(79, floor((x - lo) / ((hi - lo) / 80))) END AS INTEGER) AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, lo + b * ((hi - lo) / 80) AS low, coalesce(n, 0) AS n FROM range(80) t(b) CROSS JOIN e LEFT JOIN c ON c.bin = b WHERE lo IS NOT NULL""")
register("boxplot_stats", lambda s, d: explore.box_stats(adapter.sales_long(s, d)), f"""{BASE}, v AS (SELECT cat_id, CAST(sales AS DOUBLE) AS x FROM long WHERE sales > 0),
q AS (SELECT cat_id, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY cat_id)
SELECT q.*, min(x) AS low, max(x) AS high FROM q JOIN v USING (cat_id) WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""")
_OLS = lambda df: df.select("cat_id", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), F.col("n").cast("long").alias("n"))
register("price_elasticity_ols", lambda s, d: _OLS(explore.price_elasticity(merged(s, d))), f"""{BASE}, v AS (SELECT cat_id, ln(1 + CAST(sales AS DOUBLE)) AS y, ln(1 + CAST(sell_price AS DOUBLE)) AS x FROM merged WHERE sales > 0 AND sell_price IS NOT NULL)
SELECT cat_id, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, CAST(regr_count(y, x) AS BIGINT) AS n FROM v GROUP BY cat_id""")
register("quantile_9999", lambda s, d: explore.quantile(adapter.prices(s, d), "sell_price", 0.9999).select(F.round("q", 4).alias("q")), f"{BASE} SELECT round(quantile_cont(CAST(sell_price AS DOUBLE), 0.9999), 4) AS q FROM prices")
register("seeded_sample", lambda s, d: explore.seeded_sample(adapter.sales_long(s, d).select("id", "d_int", "sales"), 20_000, ["id", "d_int"]), f"{BASE} SELECT id, d_int, sales FROM long ORDER BY md5('42|' || id || '|' || d_int), id, d_int LIMIT 20000")

# Cleaning
register("price_cap_floor", lambda s, d: C.fill_prices(faulty(s, d)).select("id", "d_int", "sell_price"), f"{CLEAN} SELECT id, d_int, sell_price FROM clean")
register("clean_sales", lambda s, d: faulty(s, d).select("id", "d_int", C.clean_sales().alias("sales")), f"{CLEAN} SELECT id, d_int, sales FROM clean")
register("clean_events", lambda s, d: faulty(s, d).select("id", "d_int", *[C.fill_words(c, S.NO_EVENT).alias(c) for c in S.EVENT_COLUMNS]), f"{CLEAN} SELECT id, d_int, {', '.join(S.EVENT_COLUMNS)} FROM clean")
register("clean_weekday", lambda s, d: faulty(s, d).select("id", "d_int", C.fill_words("weekday", S.WEEKDAY).alias("weekday")), f"{CLEAN} SELECT id, d_int, weekday FROM clean")
register("clean_snap", lambda s, d: faulty(s, d).select("id", "d_int", *[v.alias(c) for c, v in C.clean_snap().items()]), f"{CLEAN} SELECT id, d_int, {', '.join(S.SNAP_COLUMNS)} FROM clean")
register("clean_calendar_ints", lambda s, d: faulty(s, d).select("id", "d_int", *[v.alias(c) for c, v in C.clean_integers().items()]), f"{CLEAN} SELECT id, d_int, wday, month, year FROM clean")
register("fill_price_ffill_bfill", lambda s, d: merged(s, d).select("id", "d_int", C.filled_price().alias("sell_price")), f"{BASE} SELECT id, d_int, {_FILL} AS sell_price FROM merged")
register("fill_week_global", lambda s, d: C.fill_weeks(faulty(s, d)).select("id", "d_int", "wm_yr_wk"), f"{CLEAN} SELECT id, d_int, wm_yr_wk FROM clean")
register("catch_all_fill", lambda s, d: C.catch_all(faulty(s, d).select("id", "d_int", "cat_id", "snap_TX"), {"cat_id"}), f"{CLEAN} SELECT id, d_int, cat_id, snap_TX FROM clean")
_CLEAN_COLUMNS = ["id", "d_int", "date", "sales", "sell_price", "wm_yr_wk", "weekday", "wday", "month", "year", *S.EVENT_COLUMNS, *S.SNAP_COLUMNS, "cat_id"]
register("clean_full", lambda s, d: C.clean(faulty(s, d), guard=False).df.select(*_CLEAN_COLUMNS), f"{CLEAN} SELECT {', '.join(_CLEAN_COLUMNS)} FROM clean")
register("clean_audit", lambda s, d: C.audit(faulty(s, d)).select("step", "fixed"), f"{FAULTY} SELECT 'sales_fix' AS step, count(*) FILTER (sales IS NULL OR sales < 0) AS fixed FROM faulty" + "".join(
    f" UNION ALL SELECT 'fill_{c}', count(*) FILTER ({c} IS NULL) FROM faulty" for c in [*S.EVENT_COLUMNS, "weekday", "sell_price", *S.SNAP_COLUMNS, "wday", "month", "year", "wm_yr_wk", "d_int"]))

# Features
_LAGS_SQL = ", ".join(f"CAST(coalesce(lag(sales, {n}) OVER (PARTITION BY id ORDER BY d_int), 0) AS FLOAT) AS sales_lag_{n}" for n in S.LAGS)
LAGGED = f"{TIDY}, lagged AS (SELECT *, {_LAGS_SQL} FROM tidy)"
_AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _rolling_sql(stat: str) -> str:
    one = lambda w: f"CAST(round(CAST(CAST(coalesce({_AGG[stat]}(CAST(sales_lag_28 AS DOUBLE)) OVER (PARTITION BY id ORDER BY d_int ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 0) AS FLOAT) AS DOUBLE), 4) AS FLOAT) AS rolling_{stat}_{w}d"
    return f"{LAGGED} SELECT id, d_int, {', '.join(one(w) for w in S.WINDOWS)} FROM lagged"


def _rolling(s: SparkSession, d: str, stat: str) -> DataFrame:
    df = adapter.sales_long(s, d).withColumns(X.lag_features([S.HORIZON]))
    made = X.rolling_features(stats=[stat])
    return df.select("id", "d_int", *[v.alias(c) for c, v in made.items()])


def _rolling_rounded(s: SparkSession, d: str, stat: str) -> DataFrame:
    df = _rolling(s, d, stat)
    return df.select("id", "d_int", *[F.round(F.col(c).cast("double"), 4).cast("float").alias(c) for c in df.columns[2:]])


register("sales_lags", lambda s, d: adapter.sales_long(s, d).select("id", "d_int", *[v.alias(c) for c, v in X.lag_features().items()]), f"{LAGGED} SELECT id, d_int, {', '.join(f'sales_lag_{n}' for n in S.LAGS)} FROM lagged")
for _stat in S.STATS:
    register(f"rolling_{_stat}", lambda s, d, k=_stat: _rolling_rounded(s, d, k), _rolling_sql(_stat))
_CALENDAR_SQL = """CAST(dayofyear(date) AS SMALLINT) AS day_of_year, CAST(quarter(date) AS TINYINT) AS quarter, CAST(wday IN (1, 2) AS TINYINT) AS is_weekend,
CAST(day(date) <= 3 AS TINYINT) AS is_month_start, CAST(day(date) >= 28 AS TINYINT) AS is_month_end,
CAST(month = 1 AND day(date) <= 7 AS TINYINT) AS is_year_start, CAST(month = 12 AND day(date) >= 25 AS TINYINT) AS is_year_end"""
register("calendar_flags", lambda s, d: adapter.calendar(s, d).select("d_int", *[v.alias(c) for c, v in X.calendar_features().items()]), f"{BASE} SELECT d_int, {_CALENDAR_SQL} FROM cal")
register("event_flags", lambda s, d: (lambda df: df.select("id", "d_int", *[v.alias(c) for c, v in X.event_flags(df).items()]))(tidy(s, d)), f"{TIDY} SELECT id, d_int, CAST(event_name_1 <> 'No_Event' AS TINYINT) AS has_event, CAST(event_name_2 <> 'No_Event' AS TINYINT) AS has_event_2 FROM tidy")
_SNAP_SQL = "CAST(CASE state_id " + " ".join(f"WHEN '{x}' THEN snap_{x}" for x in S.STATES) + " ELSE 0 END AS TINYINT)"
register("snap_day_flag", lambda s, d: (lambda df: df.select("id", "d_int", X.snap_flag(df)["is_snap_day"].alias("is_snap_day")))(merged(s, d)), f"{BASE} SELECT id, d_int, {_SNAP_SQL} AS is_snap_day FROM merged")
_SINCE = f"""numbered AS (SELECT id, d_int, row_number() OVER (PARTITION BY id ORDER BY d_int) AS n, event_name_1 <> 'No_Event' AS hit FROM tidy),
since AS (SELECT id, d_int, CAST(n - coalesce(max(CASE WHEN hit THEN n END) OVER ({_UP}), 0) AS SMALLINT) AS days_since_event FROM numbered)"""


def _days_since(s: SparkSession, d: str) -> DataFrame:
    df = tidy(s, d)
    made = X.days_since_event()
    return df.withColumns(X.event_flags(df)).withColumn("__n", made["__n"]).select("id", "d_int", made["days_since_event"].alias("days_since_event"))


register("days_since_event", _days_since, f"{TIDY}, {_SINCE} SELECT * FROM since")
PRICED = f"""{TIDY}, base AS (
  SELECT id, store_id, cat_id, d_int, sell_price AS p, coalesce(lag(sell_price, 7) OVER (PARTITION BY id ORDER BY d_int), sell_price) AS price_lag_7d,
         CAST(avg(CAST(sell_price AS DOUBLE)) OVER (PARTITION BY id ORDER BY d_int ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS FLOAT) AS price_rolling_mean_4w,
         CAST(avg(CAST(sell_price AS DOUBLE)) OVER (PARTITION BY id) AS FLOAT) AS sm
  FROM tidy
), groups AS (
  SELECT store_id, cat_id, CAST(avg(CAST(sell_price AS DOUBLE)) AS FLOAT) AS gm FROM tidy GROUP BY ALL
), priced AS (
  SELECT id, d_int, price_lag_7d, price_rolling_mean_4w,
         CAST(coalesce(CAST(p - price_lag_7d AS DOUBLE) / nullif(CAST(price_lag_7d AS DOUBLE), 0), 0) AS FLOAT) AS price_change_7d,
         CAST(coalesce(CAST(p AS DOUBLE) / nullif(CAST(sm AS DOUBLE), 0), 1) AS FLOAT) AS price_norm_by_item,
         CAST(coalesce(CAST(p AS DOUBLE) / nullif(CAST(gm AS DOUBLE), 0), 1) AS FLOAT) AS price_norm_by_store_cat,
         CAST(p < price_rolling_mean_4w AS TINYINT) AS is_price_promo
  FROM base JOIN groups USING (store_id, cat_id)
)"""
for _name, _columns in {
    "price_lag_change": ["price_lag_7d", "price_change_7d"],
    "price_rolling_4w": ["price_rolling_mean_4w"],
    "price_norm_item": ["price_norm_by_item"],
    "price_norm_store_cat": ["price_norm_by_store_cat"],
    "price_promo": ["is_price_promo"],
}.items():
    register(_name, lambda s, d, c=tuple(_columns): X.price_features(tidy(s, d)).select("id", "d_int", *c), f"{PRICED} SELECT id, d_int, {', '.join(_columns)} FROM priced")
_CODES_SQL = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM tidy" for c in S.ENCODED_COLUMNS)
register("label_encode", lambda s, d: X.fit_codes(tidy(s, d)), f'{TIDY}, v AS ({_CODES_SQL}) SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS SMALLINT) AS code FROM v')


def _matrix(s: SparkSession, d: str) -> DataFrame:
    """The cleaned panel's features; deviations and means rounded for comparison."""
    made = X.build(C.clean(faulty(s, d), guard=False).df, guard=False).df
    rounded = [F.round(F.col(c).cast("double"), 3).cast("float").alias(c) if c.startswith("rolling_") else F.col(c) for c in made.columns]
    return made.select(*rounded)


_ENC_SQL = ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS SMALLINT) AS {c}_enc" for c in S.ENCODED_COLUMNS)
_ROLL_SQL = ", ".join(
    f"CAST(round(CAST(CAST(coalesce({_AGG[k]}(CAST(sales_lag_28 AS DOUBLE)) OVER (PARTITION BY id ORDER BY d_int ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 0) AS FLOAT) AS DOUBLE), 3) AS FLOAT) AS rolling_{k}_{w}d"
    for w in S.WINDOWS
    for k in S.STATS
)
_MATRIX = PRICED.removeprefix(TIDY)
register("feature_matrix", _matrix, f"""{CLEAN}, tidy AS (SELECT * FROM clean){_MATRIX}, {_SINCE},
lagged AS (SELECT *, {_LAGS_SQL}, {_ENC_SQL}, {_CALENDAR_SQL}, CAST(event_name_1 <> 'No_Event' AS TINYINT) AS has_event, CAST(event_name_2 <> 'No_Event' AS TINYINT) AS has_event_2, {_SNAP_SQL} AS is_snap_day FROM tidy)
SELECT lagged.*, {_ROLL_SQL}, days_since_event, priced.* EXCLUDE (id, d_int)
FROM lagged JOIN since USING (id, d_int) JOIN priced USING (id, d_int)""")

# Smaller operators on their own
register("snap_effect_long", lambda s, d: reshape.unpivot(explore.snap_effect(dated(s, d)), ["state_id"], ["snap_mean", "other_mean"], "measure", "sales"), f"""{BASE}, m AS (
  SELECT state_id, avg(CAST(sales AS DOUBLE)) FILTER (flag = 1) AS snap_mean, avg(CAST(sales AS DOUBLE)) FILTER (flag = 0) AS other_mean
  FROM (SELECT state_id, sales, CASE state_id {" ".join(f"WHEN '{x}' THEN snap_{x}" for x in S.STATES)} END AS flag FROM merged WHERE state_id IN ('CA', 'TX', 'WI')) GROUP BY state_id)
SELECT state_id, 'snap_mean' AS measure, snap_mean AS sales FROM m UNION ALL SELECT state_id, 'other_mean', other_mean FROM m""")
register("distinct_states", lambda s, d: adapter.sales_meta(s, d).select("state_id").distinct(), f"{BASE} SELECT DISTINCT state_id FROM meta")
register("first_rows", lambda s, d: adapter.calendar(s, d).orderBy("d_int").limit(3), f"{BASE} SELECT * FROM cal ORDER BY d_int LIMIT 3")
register("coercing_cast", lambda s, d: adapter.table(s, d, "part").select("p_partkey", number("p_type", "smallint").alias("as_number"), number("p_size", "tinyint").alias("size")), "SELECT p_partkey, TRY_CAST(p_type AS SMALLINT) AS as_number, TRY_CAST(p_size AS TINYINT) AS size FROM part")
for _name in ("chunk_union", "chunk_union_all_days"):  # as above
    register(_name, lambda s, d: _all_chunks(s, d), f"{BASE} SELECT id, d, sales, d_int FROM long")
register("repeated_price_keys", lambda s, d: enrich.repeated_keys(adapter.prices(s, d).withColumn("wm_yr_wk", (F.col("wm_yr_wk") % 7).cast("smallint")), enrich.PRICE_KEY), f"{BASE} SELECT store_id, item_id, CAST(wm_yr_wk % 7 AS SMALLINT) AS wm_yr_wk, count(*) AS count FROM prices GROUP BY ALL HAVING count(*) > 1")
register("price_report", lambda s, d: explore.price_report(adapter.prices(s, d)), f"{BASE} SELECT median(CAST(sell_price AS DOUBLE)) AS median, min(sell_price) AS low, max(sell_price) AS high, count(DISTINCT store_id) AS stores FROM prices")
register("apply_codes", lambda s, d: X.encode(merged(s, d).select("id", "d_int", "weekday"), X.fit_codes(merged(s, d).where("wday > 2"), ["weekday"]), ["weekday"]).select("id", "d_int", "weekday_enc"), f"""{BASE}, v AS (SELECT value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS SMALLINT) AS code FROM (SELECT DISTINCT weekday AS value FROM merged WHERE wday > 2))
SELECT id, d_int, coalesce(code, CAST(-1 AS SMALLINT)) AS weekday_enc FROM merged LEFT JOIN v ON weekday = value""")

# Store and checks
register("walk_forward_split", lambda s, d: adapter.sales_long(s, d).select("id", "d_int", store.split_of().alias("split")).where("split is not null"), f"{BASE} SELECT id, d_int, CASE WHEN d_int <= 1800 THEN 'train' WHEN d_int <= 1856 THEN 'valid' ELSE 'test' END AS split FROM long WHERE d_int <= 1913")
register("manifest_counts", lambda s, d: store.manifest_counts(faulty(s, d)), f"""{FAULTY} SELECT count(*) AS n_rows, count(*) FILTER (d_int BETWEEN 1 AND 1800) AS train_rows, count(*) FILTER (d_int BETWEEN 1801 AND 1856) AS valid_rows,
count(*) FILTER (d_int >= 1857) AS test_rows, CAST(sum({' + '.join(f'CAST({c} IS NULL AS BIGINT)' for c in [*S.ID_COLUMNS, 'sales', 'date', 'wm_yr_wk', 'weekday', 'wday', 'month', 'year', *S.EVENT_COLUMNS, *S.SNAP_COLUMNS, 'sell_price'])}) AS BIGINT) AS null_count FROM faulty""")
_GROUP_COUNTS = {"identifiers": 8, "target": 1, "lag_features": 6, "rolling_features": 16, "calendar_features": 24, "price_features": 7, "label_encoded": 8, "other": 0}


def _groups(s: SparkSession, d: str) -> DataFrame:
    columns = X.build(tidy(s, d), guard=False).df.columns
    return s.createDataFrame([(g, len(c)) for g, c in store.feature_groups(columns).items()], "feature_group string, n int")


register("feature_groups", _groups, "SELECT * FROM (VALUES " + ", ".join(f"('{g}', {n})" for g, n in _GROUP_COUNTS.items()) + ") t(feature_group, n)")


def _raw_checks(s: SparkSession, d: str) -> DataFrame:
    meta = adapter.sales_meta(s, d)
    report = validate.validate_raw(adapter.calendar(s, d), adapter.prices(s, d), meta, expected=validate.Expected(series=150, days=adapter.DAYS))
    return report.to_frame(s).select("name", "passed")


def _processed_checks(s: SparkSession, d: str) -> DataFrame:
    return validate.validate_processed(faulty(s, d), expected=validate.Expected(series=150, days=adapter.DAYS)).to_frame(s).select("name", "passed")


register("validate_raw_checks", _raw_checks, f"""{BASE} SELECT * FROM (VALUES ('schema:calendar', true), ('schema:prices', true), ('schema:sales_meta', true), ('nulls:sales_meta', true)) t(name, passed)
UNION ALL SELECT 'nulls:calendar', count(*) FILTER (date IS NULL OR wm_yr_wk IS NULL OR weekday IS NULL) = 0 FROM cal
UNION ALL SELECT 'nulls:prices', count(*) FILTER (sell_price IS NULL) = 0 FROM prices
UNION ALL SELECT 'row_count:calendar', count(*) >= 1969 FROM cal
UNION ALL SELECT 'row_count:sales_meta', count(*) = 150 FROM meta
UNION ALL SELECT 'business_rule:price_non_negative', count(*) FILTER (sell_price < 0) = 0 FROM prices
UNION ALL SELECT 'date_range:calendar', bool_or(d = 'd_1') AND bool_or(d = 'd_{adapter.DAYS}') FROM cal
UNION ALL SELECT 'business_rule:states', count(DISTINCT state_id) FILTER (state_id IN ('CA', 'TX', 'WI')) = 3 FROM meta""")
register("validate_processed_checks", _processed_checks, f"""{FAULTY} SELECT * FROM (VALUES ('schema:processed_long', true), ('leakage_guard:d_int_present', true)) t(name, passed)
UNION ALL SELECT 'business_rule:sales_non_negative', count(*) FILTER (sales < 0) = 0 FROM faulty
UNION ALL SELECT 'nulls:processed_long', count(*) FILTER (sales IS NULL OR weekday IS NULL OR wm_yr_wk IS NULL) = 0 FROM faulty
UNION ALL SELECT 'row_count:processed_long', count(*) = 150 * {adapter.DAYS} FROM faulty""")

# Inventory
register("safety_stock", lambda s, d: inventory.safety_stock(adapter.sales_long(s, d)).select("id", F.round("mean_demand", 6).alias("mean_demand"), F.round("std_demand", 6).alias("std_demand"), F.round("safety_stock", 6).alias("safety_stock")), f"""{BASE}, m AS (SELECT id, avg(CAST(sales AS DOUBLE)) AS a, coalesce(stddev_samp(CAST(sales AS DOUBLE)), 0) AS sd FROM long GROUP BY id)
SELECT id, round(a, 6) AS mean_demand, round(sd, 6) AS std_demand, round(1.645 * sqrt(7.0 * sd * sd + a * a * 2.25), 6) AS safety_stock FROM m""")
register("total_cost", lambda s, d: inventory.safety_stock(adapter.sales_long(s, d)).select("id", F.round(inventory.total_cost("safety_stock", "mean_demand"), 6).alias("cost")), f"""{BASE}, m AS (SELECT id, avg(CAST(sales AS DOUBLE)) AS a, coalesce(stddev_samp(CAST(sales AS DOUBLE)), 0) AS sd FROM long GROUP BY id)
SELECT id, round(0.05 * (1.645 * sqrt(7.0 * sd * sd + a * a * 2.25)) + 2.0 * a, 6) AS cost FROM m""")
register("safe_divide", lambda s, d: adapter.prices(s, d).select("store_id", "item_id", "wm_yr_wk", safe_divide(F.col("sell_price"), F.col("wm_yr_wk") % 3, 1.0).alias("ratio")), f"{BASE} SELECT store_id, item_id, wm_yr_wk, CAST(coalesce(CAST(sell_price AS DOUBLE) / nullif(wm_yr_wk % 3, 0), 1) AS FLOAT) AS ratio FROM prices")

# The path from files: what is read back was written into the shared folder before


def _written(s: SparkSession, name: str, df: DataFrame) -> str:
    path = f"{readers.scratch_dir(s)}/files-{uuid.uuid4().hex}/{name}"
    df.write.csv(path, header=True)
    return path


def _wide(s: SparkSession, d: str) -> DataFrame:
    return reshape.widen_days(adapter.sales_long(s, d), _ALL_DAYS)


def _built(s: SparkSession, d: str) -> DataFrame:
    """The panel built from its three files, by the command line's function; a second call keeps what is there."""
    where = f"{readers.scratch_dir(s)}/panel-{uuid.uuid4().hex}"
    for name, df in (("calendar", adapter.calendar(s, d)), ("prices", adapter.prices(s, d)), ("sales", _wide(s, d))):
        df.write.csv(f"{where}/{panel.FILES[name]}", header=True)
    for _ in range(2):
        output = panel.build_panel(s, where, f"{where}/panel", day_range=(1, adapter.DAYS))
    return readers.read_panel(s, output)


def _stored(s: SparkSession, d: str) -> store.FeatureStore:
    made = store.FeatureStore(s, f"{readers.scratch_dir(s)}/store-{uuid.uuid4().hex}")
    df = tidy(s, d)
    made.save(df, X.fit_codes(df))
    made.save(df.limit(0))  # a complete store is kept
    return made


def _manifest(s: SparkSession, d: str) -> DataFrame:
    found = _stored(s, d).load_manifest()
    counts = [(k, int(found[k])) for k in ("n_features", "n_rows", "train_rows", "valid_rows", "test_rows", "null_count", "forecast_horizon")]
    counts += [(f"group {g}", len(c)) for g, c in found["feature_groups"].items()]
    return s.createDataFrame(counts, "name string, n bigint")


_PANEL_COLUMNS = ["id", "item_id", "store_id", "d", "d_int", "sales", "date", "wm_yr_wk", "weekday", "event_name_1", "snap_TX", "sell_price"]
register("csv_calendar", lambda s, d: readers.read_calendar(s, _written(s, "calendar", adapter.calendar(s, d))), f"{BASE} SELECT * FROM cal")
register("csv_prices", lambda s, d: readers.read_prices(s, _written(s, "prices", adapter.prices(s, d))), f"{BASE} SELECT * FROM prices")
register("csv_sales_meta", lambda s, d: readers.read_sales_meta(s, _written(s, "sales", _wide(s, d))), f"{BASE} SELECT id, item_id, dept_id, cat_id, store_id, state_id FROM meta")
register("csv_day_range", lambda s, d: reshape.melt_days(readers.read_sales_wide(s, _written(s, "sales", _wide(s, d)), (1801, 1856))).select("id", "d", "sales", "d_int"), f"{BASE} SELECT id, d, sales, d_int FROM long WHERE d_int BETWEEN 1801 AND 1856")
register("panel_build", lambda s, d: _built(s, d).select(*_PANEL_COLUMNS), f"{BASE} SELECT {', '.join(_PANEL_COLUMNS)} FROM merged")
register("store_load_valid", lambda s, d: _stored(s, d).load_split("valid", ["id", "d_int", "sales", "sell_price"]), f"{TIDY} SELECT id, d_int, sales, sell_price FROM tidy WHERE d_int BETWEEN 1801 AND 1856")
register("store_load_full", lambda s, d: _stored(s, d).load_split("full").select("id", "d_int", "sales", "event_name_1"), f"{TIDY} SELECT id, d_int, sales, event_name_1 FROM tidy")
register("store_codes", lambda s, d: _stored(s, d).load_codes(), ORACLE_SQL["label_encode"])
_TIDY_GROUPS = {"identifiers": 8, "target": 1, "lag_features": 0, "rolling_features": 0, "calendar_features": 13, "price_features": 1, "label_encoded": 0, "other": 0}
register("store_manifest", _manifest, f"""{TIDY}, c AS (SELECT count(*) AS n, count(*) FILTER (d_int <= 1800) AS a, count(*) FILTER (d_int BETWEEN 1801 AND 1856) AS b, count(*) FILTER (d_int >= 1857) AS t FROM tidy)
SELECT 'n_rows' AS name, n FROM c UNION ALL SELECT 'train_rows', a FROM c UNION ALL SELECT 'valid_rows', b FROM c UNION ALL SELECT 'test_rows', t FROM c
UNION ALL SELECT 'null_count', count(*) FILTER (sales IS NULL OR sell_price IS NULL OR event_name_1 IS NULL) FROM tidy UNION ALL SELECT 'n_features', 23 UNION ALL SELECT 'forecast_horizon', 28""" + "".join(f" UNION ALL SELECT 'group {g}', {n}" for g, n in _TIDY_GROUPS.items()))
register("files_present", lambda s, d: (lambda p: readers.file_report(s, [p, p + "-absent"]).select((F.col("path") == p).alias("written"), "present", (F.col("mb") > 0).alias("sized")))(_written(s, "prices", adapter.prices(s, d))), "SELECT * FROM (VALUES (true, true, true), (false, false, NULL)) t(written, present, sized)")
register("clean_guarded", lambda s, d: C.clean(faulty(s, d)).df.select("id", "d_int", "sales", "sell_price", "wm_yr_wk", "cat_id"), f"{CLEAN} SELECT id, d_int, sales, sell_price, wm_yr_wk, cat_id FROM clean")
register("features_guarded", lambda s, d: X.build(tidy(s, d)).df.select("id", "d_int", "sales_lag_28", "price_lag_7d", "is_snap_day"), f"{PRICED}, f AS (SELECT id, d_int, CAST(coalesce(lag(sales, 28) OVER (PARTITION BY id ORDER BY d_int), 0) AS FLOAT) AS sales_lag_28, {_SNAP_SQL} AS is_snap_day FROM tidy) SELECT id, d_int, sales_lag_28, price_lag_7d, is_snap_day FROM f JOIN priced USING (id, d_int)")
register("coercing_dates", lambda s, d: adapter.calendar(s, d).select("d_int", date(F.when(F.col("d_int") % 5 == 0, F.col("weekday")).otherwise(F.col("date").cast("string"))).alias("date")), f"{BASE} SELECT d_int, TRY_CAST(CASE WHEN d_int % 5 = 0 THEN weekday ELSE CAST(date AS VARCHAR) END AS DATE) AS date FROM cal")
register("audit_shares", lambda s, d: (lambda made: made.audit.select("step", share_text("fixed", F.lit(made.rows)).alias("share")))(C.clean(faulty(s, d), guard=False)), f"""{FAULTY}, n AS (SELECT count(*) AS rows FROM faulty), a AS ({ORACLE_SQL["clean_audit"].removeprefix(FAULTY)})
SELECT step, printf('%.2f%%', fixed * 100.0 / rows) AS share FROM a, n""")

# Guards that refuse, reports that raise, names: what they say, as rows


def _refusals(s: SparkSession, d: str) -> DataFrame:
    """The columns and nulls that each guard names when it refuses."""
    undated = faulty(s, d).withColumn("date", F.when((F.col("d_int") + F.length("id")) % 151 != 0, F.col("date")))
    where = f"{readers.scratch_dir(s)}/refused-{uuid.uuid4().hex}"
    guards = {"clean": lambda: C.clean(undated), "features": lambda: X.build(faulty(s, d)), "store": lambda: store.FeatureStore(s, where).save(faulty(s, d))}
    rows = []
    for name, guarded in guards.items():
        try:
            guarded()
        except C.NullsLeft as refused:
            rows += [(name, c, n, place) for place, (c, n) in enumerate(refused.counts.items(), 1)]
    return s.createDataFrame(rows, "guard string, column string, nulls bigint, place int")


_NULLABLE = ["sales", "date", "wm_yr_wk", "weekday", "wday", "month", "year", *S.EVENT_COLUMNS, *S.SNAP_COLUMNS, "sell_price", "cat_id"]
_NULLS_SQL = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM faulty" for c in _NULLABLE)
register("guard_refusals", _refusals, f"""{FAULTY}, n AS ({_NULLS_SQL}), r AS (SELECT *, CAST(row_number() OVER (ORDER BY nulls DESC, "column") AS INTEGER) AS place FROM n WHERE nulls > 0)
SELECT 'clean' AS guard, 'date' AS "column", count(*) AS nulls, 1 AS place FROM faulty WHERE {_K} % 151 = 0
UNION ALL SELECT g, "column", nulls, place FROM r, (VALUES ('features'), ('store')) t(g)""")
register("null_ranking", lambda s, d: C.null_ranking(faulty(s, d)), f"""{FAULTY}, n AS ({_NULLS_SQL})
SELECT CAST(row_number() OVER (ORDER BY nulls DESC, "column") AS INTEGER) AS place, "column", nulls FROM n WHERE nulls > 0""")


def _raised(s: SparkSession, d: str) -> DataFrame:
    """Whether the report of each suite raised, and how many of its checks failed."""
    series = adapter.sales_meta(s, d).count()
    expected = validate.Expected(series=series, days=adapter.DAYS)
    reports = {
        "raw": validate.validate_raw(adapter.calendar(s, d), adapter.prices(s, d), adapter.sales_meta(s, d), expected=expected),
        "processed": validate.validate_processed(faulty(s, d), expected=expected),
    }
    rows = []
    for name, report in reports.items():
        try:
            with contextlib.redirect_stdout(io.StringIO()):
                report.print_report()
            rows.append((name, report.n_failed, False))
        except RuntimeError:
            rows.append((name, report.n_failed, True))
    return s.createDataFrame(rows, "suite string, failed int, raised boolean")


register("report_raises", _raised, f"""{FAULTY}, f AS (
  SELECT 'raw' AS suite, CAST((SELECT count(*) FILTER (date IS NULL OR wm_yr_wk IS NULL OR weekday IS NULL) > 0 FROM cal) AS INTEGER) + CAST((SELECT count(*) < 1969 FROM cal) AS INTEGER)
         + CAST((SELECT count(*) FILTER (sell_price < 0) > 0 FROM prices) AS INTEGER) + CAST((SELECT count(DISTINCT state_id) FILTER (state_id IN ('CA', 'TX', 'WI')) < 3 FROM meta) AS INTEGER) AS failed
  UNION ALL SELECT 'processed', CAST(count(*) FILTER (sales < 0) > 0 AS INTEGER) + CAST(count(*) FILTER (sales IS NULL OR weekday IS NULL OR wm_yr_wk IS NULL) > 0 AS INTEGER) FROM faulty
) SELECT suite, CAST(failed AS INTEGER) AS failed, failed > 0 AS raised FROM f""")
register("feature_names", lambda s, d: s.createDataFrame([(n,) for n in X.build(tidy(s, d), guard=False).names], "feature string"), "SELECT column_name AS feature FROM (DESCRIBE " + ORACLE_SQL["feature_matrix"].replace(f"{CLEAN}, tidy AS (SELECT * FROM clean)", TIDY) + ") WHERE column_name NOT IN ('id', 'd', 'sales', 'date')")
