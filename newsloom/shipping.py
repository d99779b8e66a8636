"""Makes this package importable on executors."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files once, for workers whose path lacks it."""
    sc = spark.sparkContext
    if getattr(sc, "_newsloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="newsloom-"), "newsloom.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._newsloom_shipped = True


#: Rows and bytes of the Arrow batches that columns of texts and pages go to Python in, where the session leaves them at Spark's defaults.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20
_DEFAULTS = (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864b", BATCH_BYTES))


def _give_back() -> None:
    """Returns freed memory to the machine, which Python's and Arrow's allocators otherwise keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _by_batches(fn: Callable, columns: int) -> Callable:
    """fn over an iterator of batches; at a task's end freed memory goes back."""

    def run(batches):
        try:
            for batch in batches:
                yield fn(batch) if columns == 1 else fn(*batch)
        finally:
            _give_back()

    out = pd.DataFrame if fn.__annotations__.get("return") == "pd.DataFrame" else pd.Series
    run.__annotations__ = {"batches": Iterator[pd.Series if columns == 1 else tuple[pd.Series, ...]], "return": Iterator[out]}
    return run


def arrow_udf(fn, kind: str):
    """A vectorised UDF that is made when it is first called: a worker that imports the module has no session.

    Batches are bounded by rows and bytes, so that a worker's memory does not grow with the table.
    """

    def call(*columns):
        spark = SparkSession.active()
        ship(spark)
        for name, default, bound in _DEFAULTS:
            key = f"spark.sql.execution.arrow.{name}"
            if spark.conf.get(key) == default:
                spark.conf.set(key, str(bound))
        return F.pandas_udf(_by_batches(fn, len(columns)), kind)(*columns)

    return call
