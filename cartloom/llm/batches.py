"""Smaller Arrow batches for steps whose rows are large, and fits on bounded samples."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> Iterator[None]:
    """Jobs run inside hand tasks at most so many rows and bytes at a time; the session's own settings come back after."""
    before = {name: spark.conf.get(name) for name in (ROWS, BYTES)}
    spark.conf.set(ROWS, rows)
    spark.conf.set(BYTES, size)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def in_one_task(rows: DataFrame, work: Callable[[pa.Table], object]) -> object:
    """What `work` makes of all `rows` together, in a task of its own; None for no rows.

    For fits on samples whose size the caller has bounded: neither the sample nor the arrays of the fit are held by
    the driver. `rows` must be in a fixed order, and the result small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            result = pickle.dumps(work(pa.Table.from_batches(held)))
            yield pa.RecordBatch.from_arrays([pa.array([result], pa.binary())], names=["result"])

    found = rows.coalesce(1).mapInArrow(run, "result binary").first()
    return pickle.loads(found["result"]) if found else None
