"""What the operators of this folder share: cut lineage, text columns, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldspark.session import checkpoint_folder, configure

#: Separators of words in the contracts: space, tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one beside the warehouse if unset."""
    return checkpoint_folder(spark)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Frames made in this block remove their shuffle files when an action on them ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that a lost executor cannot undo it.

    The shuffle files it was made from are removed then; else they stay until the driver's next garbage collection.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    with _shuffles_removed(spark):
        return df.select("*").checkpoint(eager=True)


def whole(text: str | Column) -> Column:
    """The text as a string; a null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def in_groups(batch: pa.RecordBatch, column: str, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each; a longer text is a slice of its own."""
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        n = n or 0
        if i > begin and total + n > size:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def kept(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a process.

    Workers get this package by value, anew with each task, so its own globals last no longer than a task.
    """
    store = vars(sys.modules.setdefault("_kept_by_foldspark", ModuleType("_kept_by_foldspark")))
    if name not in store:
        store[name] = make()
    return store[name]


def hold() -> None:
    """Let a worker keep the memory it frees until ``give_back``: pages taken anew for each array cost as much as the work on it."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD, at its largest
        libc.mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


def give_back() -> None:
    """Return a worker's free memory to the machine: workers stay alive between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def rows_of(docs: DataFrame, keys: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """Whole rows of ``docs`` named by ``keys`` (_id, _digest, _copies: rows of ``docs`` with that id and digest).

    One row per key: of repeated rows one of those with the longest texts stays.
    ``digest`` is the expression over ``docs`` that ``_digest`` was made with.
    """
    length = sum((F.char_length(F.coalesce(F.col(c), F.lit(""))) for c, kind in docs.dtypes if kind == "string"), F.lit(0))
    keys = checkpoint(keys)
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_own_id"), digest.alias("_own"), length.alias("_length")
    )
    stay = rows.join(keys, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")))
    single = stay.filter("_copies = 1").select("_row.*")
    # only repeated rows take a second way, and only if there are any
    if keys.filter("_copies > 1").isEmpty():
        return single
    repeated = stay.filter("_copies > 1").groupBy("_id", "_digest").agg(F.max_by("_row", "_length").alias("_row"))
    return single.unionByName(repeated.select("_row.*"))


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for whole texts: Arrow batches of 1,000 rows, unless the session has its own choice."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, "1000")
    return configure(spark)
