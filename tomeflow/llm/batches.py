"""Arrow batches that fit texts, and memory that workers give back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

ROWS_CONF, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 400
BYTES_CONF, BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Hand texts to Python workers a few hundred rows and a few MB at a time.

    Spark's defaults, 10,000 rows and 64 MB, are meant for numbers; that many texts, or pairs of
    texts, are held several times over, in the JVM's Arrow buffers and in the worker.  Smaller
    settings of the session are left as they are.
    """
    now = int(spark.conf.get(ROWS_CONF))
    if now <= 0 or now > rows:
        spark.conf.set(ROWS_CONF, str(rows))
    size = spark.conf.get(BYTES_CONF, None)
    if size is None or int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)) > BYTES:
        spark.conf.set(BYTES_CONF, str(BYTES))


try:
    _trim = ctypes.CDLL(None).malloc_trim  # glibc's
except (AttributeError, OSError, TypeError):
    _trim = None


def release() -> None:
    """Give memory that is free, but that Arrow's pool and the C library hold on to, back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def releasing(rows: Callable[[Iterator], Iterator], clear: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """``rows``, which maps batches, with a ``release`` at the end of every task, after ``clear`` has emptied a table.

    Spark keeps a Python worker for the tasks of all later stages; without this each of them starts
    with what the largest one before it had taken.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from rows(batches)
        finally:
            if clear:
                clear()
            release()

    return run
