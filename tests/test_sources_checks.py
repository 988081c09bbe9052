import pytest

from panelforge.functions import schema as S
from panelforge.operators import enrich, explore, inventory, validate
from panelforge.plans import panel
from panelforge.sources import readers


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    (d / "calendar.csv").write_text(
        "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI\n"
        "2011-01-29,11101,Saturday,1,1,2011,d_1,NaN,,,,0,0,0\n2011-01-30,11101,Sunday,2,1,2011,d_2,Party,Fun,,,1,0,0\n"
    )
    (d / "sell_prices.csv").write_text("store_id,item_id,wm_yr_wk,sell_price\nS1,I1,11101,2.5\n")
    (d / "sales_train_validation.csv").write_text("id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\nx,I1,D,C,S1,CA,3,NA\ny,I2,D,C,S1,TX,0,1\n")
    return f"file://{d}"


def test_typed_csv_with_null_tokens(spark, raw):
    cal = readers.read_calendar(spark, f"{raw}/calendar.csv")
    assert dict(cal.dtypes)["wday"] == "tinyint" and cal.where("event_name_1 is null").count() == 1
    assert [r.d_int for r in cal.orderBy("d_int").collect()] == [1, 2]
    assert readers.read_sales_meta(spark, f"{raw}/sales_train_validation.csv").columns == S.ID_COLUMNS


def test_build_panel(spark, raw, tmp_path):
    out = f"file://{tmp_path}/panel"
    with pytest.raises(FileNotFoundError):
        readers.read_panel(spark, out)
    panel.build_panel(spark, raw, out)
    df = readers.read_panel(spark, out)
    assert len(df.columns) == 23 and df.count() == 4
    got = {(r.id, r.d_int): (r.sales, r.sell_price) for r in df.collect()}
    assert got == {("x", 1): (3.0, 2.5), ("x", 2): (None, 2.5), ("y", 1): (0.0, None), ("y", 2): (1.0, None)}
    assert panel.build_panel(spark, raw, out) == out  # kept
    assert readers.read_panel(spark, out, ["id", "sales"]).columns == ["id", "sales"]
    report = {r.path.rsplit("/", 1)[1]: r.present for r in readers.file_report(spark, [f"{raw}/calendar.csv", f"{raw}/none.csv"]).collect()}
    assert report == {"calendar.csv": True, "none.csv": False}


def test_checks_pass_and_fail(spark, raw):
    cal, prices = readers.read_calendar(spark, f"{raw}/calendar.csv"), readers.read_prices(spark, f"{raw}/sell_prices.csv")
    meta = readers.read_sales_meta(spark, f"{raw}/sales_train_validation.csv")
    small = validate.Expected(series=2, days=2, calendar_rows=2, states=("CA", "TX"))
    good = validate.validate_raw(cal, prices, meta, expected=small, coverage=True)
    assert good.passed and good.n_passed == 13
    assert not validate.validate_raw(cal, prices, meta, expected=small, strict=True).passed
    bad = validate.validate_raw(cal.where("d = 'd_1'"), prices.selectExpr("store_id", "item_id", "wm_yr_wk", "-sell_price sell_price"), meta.where("state_id = 'CA'"), expected=small)
    failed = {c.name for c in bad.checks if not c.passed}
    assert failed == {"row_count:calendar", "date_range:calendar", "business_rule:price_non_negative", "row_count:sales_meta", "business_rule:states"}
    with pytest.raises(RuntimeError):
        bad.print_report()
    assert not validate.validate_raw(cal.drop("wday"), prices, meta, expected=small).checks[0].passed


def test_processed_checks(spark):
    rows = [("x", "I", "D", "C", "S", "CA", "d_1", 1, 1.0, None, 11101, None)]
    df = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, d_int int, sales double, date date, wm_yr_wk int, sell_price double")
    report = validate.validate_processed(df, expected=validate.Expected(series=1, days=1))
    assert {c.name for c in report.checks if not c.passed} == {"nulls:processed_long"}  # the date; prices only warn
    assert not validate.validate_processed(df.drop("d_int"), expected=validate.Expected(series=1, days=1)).checks[4].passed
    prices = spark.createDataFrame([("S", "other", 11101, 1.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    assert not validate.validate_processed(df, prices=prices).checks[5].passed


def test_repeated_price_keys_fan_out_and_are_seen(spark):
    prices = spark.createDataFrame([("S", "I", 1, 1.0), ("S", "I", 1, 2.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    fact = spark.createDataFrame([("S", "I", 1)], "store_id string, item_id string, wm_yr_wk int")
    assert enrich.join_prices(fact, prices).count() == 2 and enrich.repeated_keys(prices, enrich.PRICE_KEY).count() == 1


def test_exploration_edges(spark):
    df = spark.createDataFrame([("S", "C", None), ("S", "C", 0.0), ("S", "C", 2.0), ("S", "C", 4.0)], "store_id string, cat_id string, sales double")
    assert explore.zero_rate(df).first().zero_rate == 0.25  # the null counts below the line
    bins = explore.histogram(df, bins=4).orderBy("bin").collect()
    assert [b.n for b in bins] == [1, 0, 0, 1]
    assert explore.seeded_sample(df, 2, ["sales"]).count() == 2 and explore.seeded_sample(df, 9, ["sales"]).count() == 4


def test_inventory(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "id string, sales double")
    got = {r.id: r.safety_stock for r in inventory.safety_stock(df).collect()}
    assert got["a"] == pytest.approx(1.645 * (7 * 2 + 4 * 2.25) ** 0.5) and got["b"] == pytest.approx(1.645 * 5 * 1.5)
    assert df.select(inventory.total_cost("sales", "sales").alias("c")).first().c == pytest.approx(2.05)
