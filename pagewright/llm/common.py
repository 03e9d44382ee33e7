"""Shared helpers of the training-data operators: scratch tables, bounded Arrow slices, partition counts."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import functools
import math
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20
#: Spark's setting by which the shuffle files of a query are removed when it has ended.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's bound of the rows it sends to a worker at once, as the JVM and the worker both hold them; Spark's own is 64 MB.
BATCH_BYTES, MOST_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)
_written: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("written", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir.

    Where it is unset, a local session (tests) gets a folder of its own; a cluster has none that all could read.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.pagewright.scratch", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
        spark.conf.set("spark.pagewright.scratch", found)
    return found.rstrip("/")


def _home(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/pagewright-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared scratch folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation, and keeps an
    iterative plan small; the shuffle files of the write go as soon as it has ended, and Python workers get rows
    in batches of MOST_BATCH bytes.  The table lives until the
    `settled` call around it ends, or until `clear_scratch`.
    """
    spark = df.sparkSession
    path = f"{_home(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _written.get()) is not None:
        paths.append(path)
    wanted = {CLEAN_SHUFFLES: "true", BATCH_BYTES: MOST_BATCH}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            _delete(spark, path)


def settled(spark: SparkSession, run: Callable[[], DataFrame], name: str) -> DataFrame:
    """What run() returns, as one scratch table; the tables that run() wrote on the way are deleted, also if it fails."""
    outer = _written.get()
    with _listing(spark):
        found = materialize(run(), name)
        path = _written.get().pop()
        if outer is not None:
            outer.append(path)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every table that this application's `materialize` has written; call it when no result is read any more."""
    _delete(spark, _home(spark))


def lower_ascii(text: Column | str) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column | str) -> Column:
    """Number of words as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_of(column: Column | str) -> Column:
    """Unsigned CRC-32 of the UTF-8 text, as a long."""
    return F.crc32(F.encode(column, "UTF-8"))


def released(run: Callable) -> Callable:
    """A batch function that gives its memory back to the system when it ends, as idle workers are kept for later stages."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return whole


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice holds about `limit` bytes of one string column.

    A row is never split, so one longer row makes a slice of its own.  Empty batches are dropped.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        lengths = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n) + 16
        yield batch.slice(start)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut record batches into some rows each, as rows that become Python objects need many times their Arrow memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def partitions_for(total_bytes: int, target: int, least: int = 1) -> int:
    return max(least, math.ceil(total_bytes / target))
