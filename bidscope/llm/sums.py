"""Sums of fixed-size integer vectors over all tasks of a pass."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "block int, part binary"


def parts(total: np.ndarray, block: int) -> pa.RecordBatch:
    """A task's vector as rows of ``block`` entries each."""
    rows = total.reshape(-1, block)
    return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array([x.tobytes() for x in rows], pa.binary())], ["block", "part"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = block = None
    for batch in batches:
        block = batch.column("block")[:1]
        for x in batch.column("part"):
            values = np.frombuffer(x.as_buffer(), np.int64)
            total = values.copy() if total is None else total + values
    yield pa.RecordBatch.from_arrays([block, pa.array([total.tobytes()], pa.binary())], ["block", "part"])


def total(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' vectors of ``size`` entries, which is all that
    reaches the driver.  Added in two steps, each in constant memory."""
    salts = 1 + math.isqrt(rows.sparkSession.sparkContext.defaultParallelism)
    once = rows.groupBy("block", F.spark_partition_id() % salts).applyInArrow(_add, SCHEMA)
    out = sorted(once.groupBy("block").applyInArrow(_add, SCHEMA).collect())
    return np.concatenate([np.frombuffer(r.part, np.int64) for r in out]) if out else np.zeros(size, np.int64)
