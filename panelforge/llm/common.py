"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handed to Python at once; Spark also closes a batch at 64 MB.
BATCH_ROWS = 2000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), for clusters without it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="panelforge-"), "panelforge_pkg.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a local session gets a
    temporary one, and a cluster an error, as no folder of the driver's machine is shared there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="panelforge-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Tables written to the shared folder and not yet removed.
_written: list[str] = []
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialise(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here, executors may be lost. ``by``:
    columns with few values, a folder for each.

    The folder is removed by ``stage_table``, or when the driver's interpreter ends, as plans built on it may run until then.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/panelforge/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by or []).parquet(path)
    if not _written:
        atexit.register(_remove_all, spark)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _path_of[out] = path
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table that ``materialise`` returned, once no plan reads it."""
    path = _path_of.pop(df)
    if path in _written:
        _written.remove(path)
        _remove(df.sparkSession, path)


def stage_table(spark: SparkSession, name: str, make) -> DataFrame:
    """``make()`` written as by ``materialise``; the tables that it needed on its way are removed."""
    before = len(_written)
    out = materialise(make(), name)
    for path in _written[before:-1]:
        _remove(spark, path)
    del _written[before:-1]
    return out


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes within are removed at the end."""
    before = len(_written)
    try:
        yield
    finally:
        for path in _written[before:]:
            _remove(spark, path)
        del _written[before:]


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _remove_all(spark: SparkSession) -> None:
    for path in _written:
        try:
            _remove(spark, path)
        except Exception:  # the application has ended; its shared folder goes with it
            return


def one_blas_thread() -> None:
    """In a Python worker: matrix products by one thread. Spark runs a worker for each core, and starts them with as many
    BLAS threads as an executor has cores; those only wait for each other."""
    if "blas" in _limited:
        return
    _limited.add("blas")
    with contextlib.suppress(OSError):
        with open("/proc/self/maps") as maps:
            libraries = {line.split()[-1] for line in maps if "openblas" in line}
        for library in libraries:
            for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                with contextlib.suppress(AttributeError):
                    getattr(ctypes.CDLL(library), name)(1)


_limited: set[str] = set()
_slot: dict = {}


def give_back() -> None:
    """In a Python worker: what is free goes back to the system, as a reused worker would hold it for the next stage."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def worker_slot(key, make):
    """``make()``, kept in the Python worker until another key is asked for: a reused worker holds one large thing."""
    if key not in _slot:
        _slot.clear()
        give_back()
        _slot[key] = make()
    return _slot[key]


#: Parts that the rows of one key are dealt into before a join.
SALTS = 32


def spread_join(df: DataFrame, small: DataFrame, on: list[str], by: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """``df`` joined with ``small``, which has one row a key, so that no task gets all rows of a key.

    Rows are dealt into ``salts`` parts of their key by a hash of ``by``. The distinct (key, part) pairs, at most
    ``salts`` a key, meet ``small`` first and then their own part: nothing is replicated for keys of few rows.
    """
    dealt = df.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    parts = dealt.select(*on, "__salt").distinct().join(small, on)
    return dealt.join(parts, [*on, "__salt"], how).drop("__salt")


def read_table(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def map_batches(df: DataFrame, function, schema: str, *, most: int = BATCH_ROWS) -> DataFrame:
    """``function(dict of lists) -> dict of lists or arrays`` over Arrow batches of ``df``, whose rows it replaces.

    Only one batch is held at a time, so memory is bounded by ``most`` rows (or 64 MB) whatever the partition.
    """
    kind = T._parse_datatype_string(schema)
    arrow = schema_to_arrow(kind)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                yield to_batch(function({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}), arrow)
        give_back()

    return df.mapInArrow(run, kind)


def extend(docs: DataFrame, text_col: str, keep: list[str] | None, added: str, work, also: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the columns ``added``, which ``work(texts, *also)`` makes as a dict of lists for each batch.

    ``keep`` names the columns of ``docs`` that stay (all by default); columns called like added ones are replaced.
    The others pass through as Arrow arrays, never as Python values.
    """
    kind = T._parse_datatype_string(added)
    names = [c for c in (docs.columns if keep is None else keep) if c not in kind.names]
    n = len(names)
    source = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)], F.col(f"`{text_col}`").cast("string").alias("__text__"), *[F.col(f"`{c}`").alias(f"__also_{i}") for i, c in enumerate(also)])
    result = T.StructType([T.StructField(c, f.dataType, f.nullable, f.metadata) for c, f in zip(names, source.schema)] + kind.fields)
    arrow = schema_to_arrow(result)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                made = work(*[c.to_pylist() for c in part.columns[n:]])
                arrays = [c if c.type == f.type else c.cast(f.type) for c, f in zip(part.columns[:n], list(arrow)[:n])]
                arrays += [pa.array(made[f.name], type=f.type) for f in list(arrow)[n:]]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        give_back()

    return source.mapInArrow(run, result)


def to_batch(columns: dict, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)


def schema_to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def arrow_schema(schema: str) -> pa.Schema:
    return schema_to_arrow(T._parse_datatype_string(schema))


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id's decimal text, as the held-out rules use it (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def bounded_sample(df: DataFrame, key: str, most: int, seed: int = 7) -> DataFrame:
    """The ``most`` rows of ``df`` with the smallest hashes of ``key`` (all, if fewer): the same rows on every run, and
    as many whatever the size of ``df``. A model may be fitted on them; results never are."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(most)


def bounded_texts(rows: DataFrame, *, most: int, most_bytes: int, by_label: bool = False, seed: int = 7) -> list[tuple[str, object]]:
    """The rows of ``bounded_rows`` as (text, label) in the order of their hashes: the texts come to the driver, within
    these bounds."""
    found = bounded_rows(rows, most=most, most_bytes=most_bytes, by_label=by_label, seed=seed)
    return [] if found is None else [(r.text, r.label) for r in sorted(found.collect(), key=lambda r: (r.h, str(r.label)))]


def bounded_rows(rows: DataFrame, *, most: int, most_bytes: int, by_label: bool = False, seed: int = 7) -> DataFrame | None:
    """(label, h, text) of distinct rows of ``rows`` (text, label), both known: those with the smallest hashes h, ``most``
    in all or, ``by_label``, of each label; each label then takes whole texts while they fit into its ``most_bytes``.
    None, if no text is taken.

    Only hashes and lengths of the candidates are ranked, of each label those in the ranges of hashes that can hold its
    smallest; the driver gets hashes and lengths only. Repeated rows count once. Rows and bytes are bounded whatever
    the table holds, if the labels are.
    """
    hashed = rows.select("label", "text", F.xxhash64("text", F.lit(seed)).alias("h"))
    sizes = hashed.groupBy("label", "h").agg(F.max(F.octet_length("text")).alias("n"))
    if by_label:
        rank = F.row_number().over(Window.partitionBy("label").orderBy("h"))
        first = _smallest_ranges(materialise(sizes, "candidates"), most).withColumn("rank", rank).where(F.col("rank") <= most).drop("rank")
    else:
        first = sizes.orderBy("h", "label").limit(most)
    room: dict = {}
    picked = []
    for row in sorted(first.collect(), key=lambda r: (r.h, str(r.label))):
        left = room.setdefault(row.label if by_label else None, most_bytes)
        if row.n <= left:
            room[row.label if by_label else None] = left - row.n
            picked.append((row.label, row.h))
    if not picked:
        return None
    chosen = rows.sparkSession.createDataFrame(picked, sizes.select("label", "h").schema)
    return hashed.join(F.broadcast(chosen), ["label", "h"]).groupBy("label", "h").agg(F.min("text").alias("text"))


def _smallest_ranges(sizes: DataFrame, most: int, bits: int = 10) -> DataFrame:
    """The rows of ``sizes`` (label, h, n) in the lowest of 2**bits equal ranges of hashes that together hold ``most`` of
    their label, or all of a label with fewer: its ``most`` smallest are among them. The driver gets a count a range."""
    at = F.shiftright("h", 64 - bits)
    ends: dict = {}
    held: dict = {}
    for row in sorted(sizes.groupBy("label", at.alias("range")).count().collect(), key=lambda r: r.range):
        if held.get(row.label, 0) < most:
            held[row.label] = held.get(row.label, 0) + row["count"]
            ends[row.label] = row.range
    bounds = sizes.sparkSession.createDataFrame(list(ends.items()), T.StructType([sizes.schema["label"], T.StructField("end", T.IntegerType())]))
    return sizes.join(F.broadcast(bounds), "label").where(at <= F.col("end")).select(*sizes.columns)
