"""Arrow batch sizes for operators that hand whole texts to Python workers."""

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows and bytes of a batch. Texts may be long, so both are far below Spark's defaults.
TEXT_ROWS = 500
TEXT_BYTES = 8 << 20


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS, size: int = TEXT_BYTES) -> None:
    """Bound what a Python worker holds at once; results don't depend on it.

    These are settings of the session, as Spark has none for a single plan, so
    they are set by queries and not by operators.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def give_back() -> None:
    """Hand what a task has freed back to the system: workers stay, and keep their heaps, for the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library
