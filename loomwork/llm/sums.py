"""Sums of dense arrays over all partitions: what a fixed-size model gathers from a whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import map_arrow

_BYTES = 1 << 17
_FAN = 64


def dense_sum(df: DataFrame, add: Callable[[np.ndarray, pa.RecordBatch], None], shape: tuple[int, int], dtype: str = "float32") -> np.ndarray:
    """The sum over partitions of the array that ``add`` fills batch by batch.

    Every task keeps one array of the given shape and emits it once, in blocks of rows
    without those that are all zero; blocks are summed in levels of ``_FAN`` partitions, so
    no task holds more than that many blocks (the last level: the partitions over
    ``_FAN`` squared). The driver gets one array of that fixed shape.
    """
    rows, width = shape
    per = max(1, _BYTES // (width * np.dtype(dtype).itemsize))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape, dtype=dtype), False
        for batch in batches:
            if batch.num_rows:
                some = True
                add(total, batch)
        if some:
            salt = TaskContext.get().partitionId() // _FAN
            for at in range(0, rows, per):
                if (part := total[at : at + per]).any():
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([salt], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["at", "salt", "data"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.frombuffer(pdf["data"].iloc[0], dtype=dtype).astype("float64")
        for data in pdf["data"].iloc[1:]:
            out += np.frombuffer(data, dtype=dtype)
        return pd.DataFrame({"at": pdf["at"].iloc[:1], "salt": pdf["salt"].iloc[:1], "data": [out.astype(dtype).tobytes()]})

    kind = "at long, salt int, data binary"
    parts = map_arrow(df, local, kind).groupBy("at", "salt").applyInPandas(merge, kind)
    parts = parts.groupBy("at", F.floor(F.col("salt") / _FAN).alias("salt")).applyInPandas(merge, kind)
    out = np.zeros(shape, dtype=dtype)
    for row in parts.groupBy("at").applyInPandas(merge, kind).toLocalIterator():
        part = np.frombuffer(row["data"], dtype=dtype).reshape(-1, width)
        out[row["at"] : row["at"] + len(part)] = part
    return out
