import pytest
from pyspark.sql import functions as F

from panelforge.functions import scalars
from panelforge.operators import clean as C

SCHEMA = (
    "id string, d string, sales double, event_name_1 string, weekday string, wday tinyint, month tinyint, year smallint, "
    "wm_yr_wk smallint, snap_CA tinyint, sell_price float, cat_id string, date date"
)


def frame(spark, rows):
    import datetime

    base = {"id": "a", "d": "d_1", "sales": 1.0, "event_name_1": None, "weekday": "Monday", "wday": 1, "month": 1, "year": 2011, "wm_yr_wk": 11101, "snap_CA": 0, "sell_price": 1.0, "cat_id": "x", "date": datetime.date(2011, 1, 1)}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], SCHEMA)


def test_day_index_orders_by_number_and_fills_zero(spark):
    df = C.with_day_index(frame(spark, [{"d": "d_10"}, {"d": "d_2"}, {"d": "x"}, {"d": None}]))
    assert sorted(r.d_int for r in df.collect()) == [0, 0, 2, 10]


@pytest.mark.parametrize("value, want", [(None, 0.0), (float("nan"), 0.0), (-3.0, 0.0), (2.0, 2.0)])
def test_sales(spark, value, want):
    assert frame(spark, [{"sales": value}]).select(C.clean_sales().alias("s")).first().s == want


def test_words_that_stand_for_null_are_filled_case_sensitively(spark):
    df = spark.createDataFrame([(x,) for x in [None, "nan", "NaN", "None", "<NA>", "", "NAN", "X"]], "w string")
    got = [r[0] for r in df.select(scalars.fill_words("w", "-")).collect()]
    assert got == ["-"] * 6 + ["NAN", "X"]


def price(spark, values, **more):
    rows = [{"id": i, "d": f"d_{d}", "sell_price": p} for i, d, p in values]
    return {(r.id, r.d_int): round(r.sell_price, 4) for r in C.clean(frame(spark, rows)).df.collect()}


def test_price_gaps_fill_forward_then_backward_and_fall_back_to_the_median(spark):
    got = price(spark, [("a", 1, None), ("a", 2, 3.0), ("a", 10, None), ("b", 1, None), ("c", 1, 5.0)])
    assert got[("a", 1)] == got[("a", 2)] == got[("a", 10)] == 3.0
    assert got[("b", 1)] == 3.0  # median of 3, 3, 3, 5


def test_all_prices_null_fall_back_to_one(spark):
    assert set(price(spark, [("a", 1, None), ("b", 1, None)]).values()) == {1.0}


def test_cap_and_floor_only_if_a_price_was_null(spark):
    assert price(spark, [("a", 1, 0.0), ("b", 1, 4.0)])[("a", 1)] == 0.0
    assert price(spark, [("a", 1, 0.0), ("a", 2, None), ("b", 1, 4.0)])[("a", 1)] == 0.01


def test_week_fill_crosses_series(spark):
    rows = [("a", 1, None), ("a", 2, 7), ("b", 1, None), ("b", 2, 9), ("c", 1, None)]
    df = C.fill_weeks(C.with_day_index(frame(spark, [{"id": i, "d": f"d_{d}", "wm_yr_wk": w} for i, d, w in rows])))
    got = {(r.id, r.d_int): r.wm_yr_wk for r in df.collect()}
    assert got == {("a", 1): 7, ("a", 2): 7, ("b", 1): 7, ("b", 2): 9, ("c", 1): 9}


def test_catch_all_sweeps_words_only_where_a_null_was(spark):
    with_null = C.clean(frame(spark, [{"cat_id": None}, {"cat_id": "NaN", "id": "b"}])).df
    without = C.clean(frame(spark, [{"cat_id": "NaN"}])).df
    assert {r.cat_id for r in with_null.collect()} == {"Unknown"}
    assert without.first().cat_id == "NaN"


def test_audit_counts_the_input_and_null_date_raises(spark):
    df = frame(spark, [{"sales": -1.0}, {"sales": None, "id": "b"}, {"weekday": None, "id": "c"}])
    audit = {r.step: r.fixed for r in C.clean(df).audit.collect()}
    assert audit["sales_fix"] == 2 and audit["fill_weekday"] == 1 and audit["fill_event_name_1"] == 3
    assert {r.step: r.fixed for r in C.audit(df).collect()} == audit
    with pytest.raises(RuntimeError, match="date"):
        C.clean(frame(spark, [{"date": None}]))


def test_empty_table(spark):
    assert C.clean(frame(spark, [])).df.count() == 0


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 1.0), (float("inf"), 1.0)], "a float, b float")
    assert [r[0] for r in df.select(scalars.safe_divide("a", "b", 7.0)).collect()] == [7.0, 0.5, 7.0, 7.0]
    assert df.select(F.count("*")).first()[0] == 4
