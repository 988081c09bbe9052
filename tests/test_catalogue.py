"""The catalogue's queries against their SQL on the smallest tables."""

import os

import pytest

from panelforge.plans import catalogue

SF = "/root/testdata/sf0.001"
CHEAP = ["scan_prune", "lean_projection", "price_scan", "join_calendar_left", "null_audit", "snap_effect", "sales_histogram", "fill_week_global", "days_since_event", "label_encode", "walk_forward_split"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in "region nation supplier part lineitem".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHEAP)
def test_against_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    found = duck.execute(catalogue.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    spell = lambda row: tuple("" if v is None else str(v) for v in row)
    order = sorted(df.columns)
    theirs = sorted(spell(dict(zip(names, r))[c] for c in order) for r in found.fetchall())
    assert sorted(spell(r[c] for c in order) for r in df.collect()) == theirs


@pytest.mark.parametrize("name", ["melt_all_days", "chunk_union_all_days"])
def test_every_day_is_melted(spark, duck, name):
    test_against_sql(spark, duck, name)


@pytest.mark.parametrize("name", ["csv_calendar", "csv_prices", "store_codes", "files_present", "clean_guarded", "coercing_dates", "audit_shares", "guard_refusals", "null_ranking", "report_raises", "feature_names", "boxplot_stats", "seeded_sample"])
def test_files_store_and_guards(spark, duck, name):
    test_against_sql(spark, duck, name)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)
