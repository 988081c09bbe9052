import datetime

import pytest
from pyspark.sql import functions as F

from panelforge.functions import schema as S
from panelforge.operators import features as X
from panelforge.operators import reshape
from panelforge.plans import store as st


def panel(spark, n=100, series=("a", "b")):
    start = datetime.date(2011, 1, 29)
    rows = []
    for s in series:
        for d in range(1, n + 1):
            date = start + datetime.timedelta(days=d - 1)
            event = "E" if d in (3, 7) else "No_Event"
            rows.append((s, "i", "dep", "c", "st", "CA", f"d_{d}", d, float(d % 5), date, 11101 + d // 7, "Monday", (date.isoweekday() + 1) % 7 + 1, date.month, date.year, event, event, "No_Event", "No_Event", int(d % 2), 0, 0, float(1 + d % 3)))
    kind = (
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, d_int smallint, sales float, date date, "
        "wm_yr_wk smallint, weekday string, wday tinyint, month tinyint, year smallint, event_name_1 string, event_type_1 string, event_name_2 string, "
        "event_type_2 string, snap_CA tinyint, snap_TX tinyint, snap_WI tinyint, sell_price float"
    )
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="module")
def built(spark):
    return X.build(panel(spark))


def test_shape_and_groups(built):
    assert len(built.df.columns) == 70 and len(built.names) == 66
    assert [len(c) for c in st.feature_groups(built.df.columns).values()] == [8, 1, 6, 16, 24, 7, 8, 0]


def test_first_group_wins():
    names = ["d_int", "sales", "sales_lag_99", "rolling_x_enc", "snap_CA", "price_x_enc", "sell_price", "store_id_enc", "sales_x", "quarters", ""]
    of = ["identifiers", "target", "lag_features", "rolling_features", "calendar_features", "price_features", "price_features", "label_encoded", "other", "other", "other"]
    assert [st.group_of(n) for n in names] == of


def test_lags_and_windows(built):
    rows = {r.d_int: r for r in built.df.where("id = 'a'").collect()}
    assert rows[28].sales_lag_28 == 0 and rows[29].sales_lag_28 == 1.0
    lagged = [float((d - 28) % 5) if d > 28 else 0.0 for d in range(1, 101)]
    for d in (1, 30, 60, 100):
        for w in S.WINDOWS:
            frame = lagged[max(0, d - w) : d]
            assert rows[d][f"rolling_mean_{w}d"] == pytest.approx(sum(frame) / len(frame), rel=1e-6)
            assert rows[d][f"rolling_min_{w}d"] == min(frame) and rows[d][f"rolling_max_{w}d"] == max(frame)
    assert rows[1].rolling_std_7d == 0.0


def test_days_since_event_counts_from_one_before_the_first(built):
    rows = {r.d_int: r.days_since_event for r in built.df.where("id = 'a'").collect()}
    assert [rows[d] for d in range(1, 9)] == [1, 2, 0, 1, 2, 3, 0, 1]


def test_series_without_event_and_unknown_state(spark):
    df = panel(spark, 5, ("a",)).withColumns({"event_name_1": F.lit("No_Event"), "state_id": F.lit("XX")})
    rows = X.build(df).df.orderBy("d_int").collect()
    assert [r.days_since_event for r in rows] == [1, 2, 3, 4, 5] and {r.is_snap_day for r in rows} == {0}


def test_one_shuffle_by_series_for_lags_and_windows(spark):
    df = panel(spark, 10).withColumns(X.lag_features()).withColumns(X.rolling_features())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1 and "SinglePartition" not in plan and "Python" not in plan


def test_codes_are_places_in_binary_order_and_unseen_values_minus_one(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "B", "10", "9", "a"]], "item_id string")
    codes = X.fit_codes(df, ["item_id"])
    assert {r.value: r.code for r in codes.collect()} == {"10": 0, "9": 1, "B": 2, "a": 3, "b": 4}
    new = spark.createDataFrame([("zz",), ("a",)], "item_id string")
    assert {r.item_id: r.item_id_enc for r in X.encode(new, codes, ["item_id"]).collect()} == {"zz": -1, "a": 3}


def test_gates(spark):
    with pytest.raises(ValueError, match="leak"):
        S.FeatureConfig(lags=(7, 28))
    with pytest.raises(ValueError, match="need the lag"):
        S.FeatureConfig(lags=(30,))
    with pytest.raises(ValueError, match="unknown"):
        S.FeatureConfig(stats=("median",))
    with pytest.raises(ValueError, match="missing"):
        X.build(panel(spark, 3).drop("sales"))
    with pytest.raises(ValueError, match="nulls"):
        X.build(panel(spark, 3).withColumn("sell_price", F.lit(None).cast("float")))


def test_zero_price_divisor(spark):
    df = panel(spark, 9, ("a",)).withColumn("sell_price", F.lit(0).cast("float"))
    row = X.build(df).df.where("d_int = 9").first()
    assert (row.price_change_7d, row.price_norm_by_item, row.is_price_promo) == (0.0, 1.0, 0)


def test_store_round_trip(spark, tmp_path, built):
    store = st.FeatureStore(spark, f"file://{tmp_path}/fs")
    with pytest.raises(FileNotFoundError):
        store.load_split("train")
    df = panel(spark, 5, ("a",)).withColumn("d_int", F.element_at(F.array(*[F.lit(x) for x in (1, 1800, 1801, 1857, 1914)]), F.col("d_int").cast("int")).cast("smallint"))
    store.save(df, built.codes)
    assert store.load_split("train").count() == 2 and store.load_split("valid").count() == 1 and store.load_split("test").count() == 1
    assert store.load_split("full").count() == 5 and store.exists()
    manifest = store.load_manifest()
    assert len(manifest) == 15 and manifest["test_rows"] == 2 and manifest["n_features"] == 23
    plan = store.load_split("test", ["id", "sales"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert store.load_codes().count() == built.codes.count()
    with pytest.raises(ValueError):
        store.load_split("nope")
    with pytest.raises(RuntimeError):
        store.save(df.drop("d_int"), force=True)
    with pytest.raises(RuntimeError):
        store.save(df.withColumn("sales", F.lit(None).cast("float")), force=True)


def test_melt_is_the_inverse_of_widen(spark):
    long = panel(spark, 6).select(*S.ID_COLUMNS, "d", "sales", "d_int")
    days = [f"d_{n}" for n in range(1, 7)]
    back = reshape.melt_days(reshape.widen_days(long, days))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_melt_keeps_null_cells_and_pivot_refuses_repeats(spark):
    wide = spark.createDataFrame([("a", 1.0, None)], "id string, d_1 float, d_2 float")
    assert sorted((r.d, r.sales) for r in reshape.melt_days(wide, ids=["id"]).collect()) == [("d_1", 1.0), ("d_2", None)]
    twice = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0)], "i string, c string, v double")
    with pytest.raises(Exception, match="pivot"):
        reshape.pivot(twice, "i", "c", "v", ["x"]).collect()


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 70_000, 1.5, "a"), (2, 2, 2.5, "a"), (3, 2, 2.5, "a")], "a bigint, b bigint, c double, s string")
    assert dict(reshape.narrow_types(df).dtypes) == {"a": "tinyint", "b": "int", "c": "float", "s": "string"}
    assert {r.column: r.categorical for r in reshape.cast_plan(df).collect()}["s"] is True
    assert dict(reshape.narrow_types(df.where("false")).dtypes)["a"] == "bigint"
