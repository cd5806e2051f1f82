"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

#: Rows of a record batch that are turned into Python objects at a time.
SLICE_ROWS = 256

T = TypeVar("T")

PACKAGE = Path(__file__).resolve().parents[1]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels table."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of a local master this package, once for each context.

    A local session may have been started from any folder.  On a cluster the package is
    installed or passed with ``--py-files``, as for any Spark job."""
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False) or not (sc.master == "local" or sc.master.startswith("local[")):
        return
    path = os.path.join(tempfile.mkdtemp(), f"riskloom_{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    sc.addPyFile(path)
    sc._riskloom_shipped = True


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that wrote them, where this version of Spark knows
    the setting; what is run here is stored or collected, so they are of no more use."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    try:
        before = spark.conf.get(key)
        spark.conf.set(key, "true")
    except Exception:  # a Spark version without the setting
        before = None
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(key, before)


def store(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back:
    later steps read stored rows, so a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in stored:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


_kept: dict = {}


def worker_state(key: object, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept in this worker process until another key is asked for:
    a worker that serves one operator after the other holds the tables of one, and gives
    the memory of the others back to the system."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            _give_back_memory()
        _kept[key] = make()
    return _kept[key]


def _give_back_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """Python lists of the columns, some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield tuple(part.column(c).to_pylist() for c in columns)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as decimal text, modulo ``folds``, equals ``fold``.  A NULL
    id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def same(a: Column, b: Column) -> Column:
    """Equality under which two NULLs are equal."""
    return a.eqNullSafe(b)


#: Columns of documents that keep their names inside operators.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def whole_rows(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For an operator that returns rows of its first argument with all their columns: columns
    that are not those of documents have other names inside it, so that none can clash with
    a helper column or, by case alone, with a column of documents."""

    @wraps(operator)
    def run(docs: DataFrame, *args: object, **options: object) -> DataFrame:
        names = docs.columns
        inside = [c if c in DOCUMENT_COLUMNS else f"_column_{k}" for k, c in enumerate(names)]
        return operator(docs.toDF(*inside), *args, **options).select(*inside).toDF(*names)

    return run


def exactly(df: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, found by their exact names: one that differs in case alone
    (``TEXT`` beside ``text``) clashes with none of them."""
    by_place = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    return by_place.select(*[F.col(f"_{df.columns.index(c)}").alias(c) for c in columns])
