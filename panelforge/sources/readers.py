"""Readers of the three raw tables and of the processed panel."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import schema as S
from panelforge.functions.scalars import date, day_index, nan_to_null

# Tokens that CSV files of the raw data write for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed, lazy scan by header names: no inference, and every null token becomes null before the cast. What is no
    date becomes null; what is no number raises."""
    names = spark.read.csv(path, header=True, enforceSchema=False).columns
    raw = spark.read.csv(path, header=True, schema=T.StructType([T.StructField(n, T.StringType()) for n in names]))
    present = [f for f in schema if f.name in names]
    clean = lambda c: F.when(~F.col(f"`{c}`").isin(NULL_TOKENS), F.col(f"`{c}`"))
    typed = lambda f: date(clean(f.name)) if isinstance(f.dataType, T.DateType) else clean(f.name).cast(f.dataType)
    return nan_to_null(raw.select(*[typed(f).alias(f.name) for f in present]))


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.CALENDAR).withColumn("d_int", day_index("d"))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.PRICES)


def read_sales_meta(spark: SparkSession, path: str) -> DataFrame:
    """Only the ids: the scan prunes the day columns."""
    return read_csv(spark, path, S.sales_wide(1, 0))


def read_sales_wide(spark: SparkSession, path: str, day_range: tuple[int, int] | None = None) -> DataFrame:
    return read_csv(spark, path, S.sales_wide(*(day_range or (1, S.LAST_DAY))))


def read_panel(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"no panel at {path}: build it first")
    panel = spark.read.parquet(path)
    return panel.select(*columns) if columns else panel


def scratch_dir(spark: SparkSession) -> str:
    """A folder for intermediate files within spark.checkpoint.dir, which driver and executors share; where that is unset
    a local session gets a temporary one, and a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="panelforge-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/panelforge"


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _path(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in a folder."""
    where, fs = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(where)] if fs.exists(where) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet folder was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _path(spark, path)
    if not fs.exists(where):
        raise FileNotFoundError(path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the old text or the new one, never a part: it is written beside ``path`` and then renamed over it."""
    beside, fs = _path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(beside, _path(spark, path)[0], options)


def file_report(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, present, mb) of each path, by the file system it is on."""
    rows = []
    for path in paths:
        where, fs = _path(spark, path)
        found = fs.exists(where)
        rows.append((path, found, fs.getContentSummary(where).getLength() / 1e6 if found else None))
    return spark.createDataFrame(rows, "path string, present boolean, mb double")
