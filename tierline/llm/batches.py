"""What whole texts take of an executor's memory outside the heap, on their way to Python and there."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 1000
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(texts: DataFrame) -> DataFrame:
    """``texts``, of which Python gets ROWS rows at a time at most.

    Spark's default is 10,000, and it holds such a batch outside the heap, in arrays that double as they
    grow, while Python holds its own copy. The setting belongs to the session and is read when a plan
    runs, so it stays; a smaller one is left as it is.
    """
    conf = texts.sparkSession.conf
    if not 0 < int(conf.get(SETTING, "10000")) <= ROWS:
        conf.set(SETTING, str(ROWS))
    return texts


def give_back() -> None:
    """Free memory of this Python worker, which outlives its task, goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)
