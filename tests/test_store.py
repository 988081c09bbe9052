"""The store's saves: one computation, one commit, sorted files."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelforge.operators import clean as C
from panelforge.operators import features as X
from panelforge.plans import store as st
from panelforge.sources import readers, staging


def rows(spark, series=8, days=1913, price=1.0):
    ids = spark.range(series).select(F.format_string("s%03d", "id").alias("id"))
    return ids.crossJoin(spark.range(1, days + 1).select(F.col("id").cast("smallint").alias("d_int"))).select("id", "d_int", F.lit(price).cast("float").alias("sell_price"))


def counted(spark, df):
    """(``df``, an accumulator of the rows that were computed)."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_save_computes_its_input_once(spark, tmp_path):
    df, seen = counted(spark, rows(spark))
    store = st.FeatureStore(spark, f"file://{tmp_path}/fs")
    store.save(df)
    assert seen.value == 8 * 1913
    found = store.load_manifest()
    assert (found["n_rows"], found["train_rows"], found["valid_rows"], found["test_rows"], found["null_count"]) == (8 * 1913, 8 * 1800, 8 * 56, 8 * 57, 0)
    assert store.load_split("full").count() == 8 * 1913


def test_guards_compute_their_input_once_and_refuse(spark, tmp_path):
    store = st.FeatureStore(spark, f"file://{tmp_path}/fs")
    df, seen = counted(spark, rows(spark, 3, 10).withColumn("sell_price", F.when(F.col("d_int") > 4, F.col("sell_price"))))
    with pytest.raises(C.NullsLeft) as refused:
        store.save(df)
    assert refused.value.counts == {"sell_price": 12} and seen.value == 30 and not store.exists()
    for guarded in (lambda f: X.stage_without_nulls(f, staging.Staging(spark), "x", C.NullsGiven), lambda f: C.clean(f.withColumn("date", F.lit(None).cast("date")))):
        df, seen = counted(spark, rows(spark, 3, 10).withColumn("sell_price", F.lit(None).cast("float")))
        with pytest.raises(C.NullsLeft):
            guarded(df)
        assert seen.value == 30


def test_a_save_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    where = f"file://{tmp_path}/fs"
    store = st.FeatureStore(spark, where)
    codes = spark.createDataFrame([("c", "a", 0)], "column string, value string, code smallint")
    store.save(rows(spark, 2, 5), codes)

    def dies(*_):
        raise KeyboardInterrupt

    for broken in ("write_text",):
        monkeypatch.setattr(readers, broken, dies)
        with pytest.raises(KeyboardInterrupt):
            store.save(rows(spark, 4, 5, price=9.0), codes.limit(0), force=True)
        monkeypatch.undo()
        again = st.FeatureStore(spark, where)
        assert again.exists() and again.load_split("full").count() == 10 and again.load_codes().count() == 1
        assert again.load_manifest()["n_rows"] == 10
    assert len(readers.children(spark, f"{where}/versions")) == 2
    store.vacuum()
    assert readers.children(spark, f"{where}/versions") == [store.load_manifest()["version"]]
    assert not glob.glob(f"{tmp_path}/fs/manifest.json.*")


def test_versions_older_than_the_last_go_and_readers_of_the_last_stay(spark, tmp_path):
    store = st.FeatureStore(spark, f"file://{tmp_path}/fs")
    store.save(rows(spark, 1, 5))
    reader = store.load_split("full")
    store.save(rows(spark, 2, 5), force=True)
    assert reader.count() == 5 and store.load_split("full").count() == 10
    store.save(rows(spark, 3, 5), force=True)
    assert len(readers.children(spark, f"{store.path}/versions")) == 2 and store.load_split("full").count() == 15


def test_a_filter_on_id_meets_few_row_groups(spark, tmp_path):
    store = st.FeatureStore(spark, f"file://{tmp_path}/fs")
    store.save(rows(spark, 40), file_rows=4000)
    groups = []
    for path in glob.glob(f"{tmp_path}/fs/versions/*/features/split=train/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("id")
        table = pq.read_table(path, columns=["id", "d_int"], partitioning=None).to_pylist()
        assert table == sorted(table, key=lambda r: (r["id"], r["d_int"]))
        groups += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    hit = sum(s.min <= "s017" <= s.max for s in groups)
    assert len(groups) >= 15 and hit <= 3


def test_nothing_staged_is_left(spark, tmp_path):
    before = set(readers.children(spark, readers.scratch_dir(spark)))
    st.FeatureStore(spark, f"file://{tmp_path}/fs").save(rows(spark, 2, 5))
    made = C.clean(rows(spark, 2, 5).withColumn("id", F.col("id")))
    assert made.df.count() == 10
    made.release()
    assert set(readers.children(spark, readers.scratch_dir(spark))) == before
